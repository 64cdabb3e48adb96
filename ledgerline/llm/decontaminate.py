"""Benchmark decontamination by size-partitioned MinHash containment search.

Which share of a test item's shingles a document holds says nothing about
their Jaccard similarity unless the document's size is known, so documents are
partitioned by size (powers of two of the shingle count), as in an LSH
ensemble. Signatures are one-permutation MinHash: one hash per shingle, the hash
space cut into bins, the minimum of each bin. A partition of documents with at
most ``u`` shingles has ``BINS_PER_SHINGLE * u`` bins, so a shingle shared with
an item is the minimum of its bin with a probability of at least 0.88 whatever
the document's length, and an item that shares ``s`` shingles is missed with
0.12^s. Items of which fewer than ``SURE`` shared shingles suffice are looked up
by all their shingles instead, which misses none.

Item signatures are a sorted array of hashes per partition, sent to the tasks
when their measured size is at most ``BROADCAST_BYTES``; larger benchmarks are
joined by shuffles on the signature. Either way every candidate is verified by
exact containment of its shingles.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches, stage

WORDS = 5
CONTAINMENT = 0.8
BINS_PER_SHINGLE = 4
#: 0.12 ** 10 < 1e-9.
SURE = 10
BROADCAST_BYTES = 32 << 20

_WORD = re.compile(r"\w+")


def shingles(text: str | None, size: int) -> list[str]:
    """``size``-word shingles of the lower-cased words (letters, digits, underscore); fewer words: the whole sequence."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return []
    if len(words) <= size:
        return [" ".join(words)]
    return [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def hashes(grams) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(g.encode("utf-8", "surrogatepass")) for g in grams), np.uint64))


def partition_of(n_shingles: int) -> int:
    """Size partition: documents of at most ``2 ** partition`` distinct shingles."""
    return max(0, int(n_shingles - 1).bit_length())


def bin_minima(sorted_hashes: np.ndarray, partition: int) -> np.ndarray:
    """One-permutation MinHash: the smallest hash of every non-empty bin."""
    bits = partition + BINS_PER_SHINGLE.bit_length() - 1
    bins = sorted_hashes >> np.uint64(64 - bits)
    return sorted_hashes[np.r_[True, bins[1:] != bins[:-1]]] if len(bins) else sorted_hashes


def needed(n_shingles: int, containment: float) -> int:
    return max(1, int(np.ceil(containment * n_shingles - 1e-9)))


class ItemIndex:
    """Items by the signature hashes of each size partition of documents."""

    def __init__(self, items: list[tuple[int, str]], size: int, containment: float):
        self.size, self.containment = size, containment
        self.ids = [i for i, _ in items]
        self.grams = [set(shingles(t, size)) for _, t in items]
        self.hashes = [hashes(g) for g in self.grams]
        # Items of fewer than ``size`` words are one shorter shingle: documents need those lengths as well.
        self.short = sorted({len(_WORD.findall((t or "").lower())) for _, t in items} & set(range(1, size)))
        self._partitions: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def signatures(self, partition: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted hashes, index of their item) for documents of one partition."""
        if partition not in self._partitions:
            keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for i, h in enumerate(self.hashes):
                sure = needed(len(h), self.containment) < SURE
                keys.append(h if sure else bin_minima(h, partition))
                owners.append(np.full(len(keys[-1]), i))
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(key, kind="stable")
            self._partitions[partition] = key[order], owner[order]
        return self._partitions[partition]

    def candidates(self, doc: np.ndarray) -> np.ndarray:
        """Items whose signature meets that of a document (its sorted distinct hashes)."""
        key, owner = self.signatures(partition_of(len(doc)))
        if not len(key) or not len(doc):
            return np.empty(0, np.int64)
        # Items that must not be missed meet every shingle; the others the bin minima of the partition.
        minima = bin_minima(doc, partition_of(len(doc)))
        found = []
        for probe, sure in ((doc, True), (minima, False)):
            low, high = np.searchsorted(key, probe, "left"), np.searchsorted(key, probe, "right")
            for a, b in zip(low[high > low], high[high > low], strict=True):
                found.extend(i for i in owner[a:b] if (needed(len(self.hashes[i]), self.containment) < SURE) == sure)
        return np.unique(np.array(found, np.int64))

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, shingles of the item, those in the text) for each item contained in the text."""
        grams = set(shingles(text, self.size))
        for n in self.short:
            grams.update(_fixed(text, n))
        out = []
        for i in self.candidates(hashes(grams)):
            shared = len(self.grams[i] & grams)
            if shared >= needed(len(self.grams[i]), self.containment):
                out.append((self.ids[i], len(self.grams[i]), shared))
        return out


def _fixed(text: str | None, n: int) -> list[str]:
    words = _WORD.findall((text or "").lower())
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def _by_broadcast(docs: DataFrame, items: list[tuple[int, str]], size: int, containment: float) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, size, containment))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out.extend((doc_id, *m) for m in index.value.matches(text))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_shingles", "n_shared"]
            )

    return docs.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long")


def _signature_rows(rows: DataFrame, size: int, containment: float, short: list[int], items: bool) -> DataFrame:
    """(key, partition, sure, id) rows: for items in all partitions they can meet, for documents in their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for row_id, text in zip(batch["id"], batch["text"], strict=True):
                grams = set(shingles(text, size))
                for n in () if items else short:
                    grams.update(_fixed(text, n))
                h = hashes(grams)
                sure = items and needed(len(h), containment) < SURE
                if items and sure:
                    parts.append((row_id, -1, h))
                elif items:
                    parts.extend((row_id, p, bin_minima(h, p)) for p in range(40))
                else:
                    parts.append((row_id, -1, h))
                    parts.append((row_id, partition_of(len(h)), bin_minima(h, partition_of(len(h)))))
            yield pd.DataFrame(
                {
                    "id": np.repeat([p[0] for p in parts], [len(p[2]) for p in parts]),
                    "partition": np.repeat([p[1] for p in parts], [len(p[2]) for p in parts]),
                    "key": np.concatenate([p[2] for p in parts] or [np.empty(0, np.uint64)]).view(np.int64),
                }
            )

    return rows.mapInPandas(run, "id long, partition int, key long")


def _short_lengths(items: DataFrame, size: int) -> DataFrame:
    """Numbers of words of the items with fewer than ``size``, by the words of ``shingles``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = batch["text"].map(lambda t: len(_WORD.findall((t or "").lower()))).astype("int64")
            yield pd.DataFrame({"n": n[(n >= 1) & (n < size)].unique()})

    return items.select("text").mapInPandas(run, "n long")


def _by_shuffle(docs: DataFrame, items: DataFrame, size: int, containment: float) -> DataFrame:
    """The same search when the items are too large to send: joins on the signature, then exact containment."""
    short = sorted(r["n"] for r in _short_lengths(items, size).distinct().collect())  # at most size - 1 values
    wanted = stage(_signature_rows(items.select(F.col("item_id").alias("id"), "text"), size, containment, short, True), "decon-items")
    rows = docs.select(F.col("doc_id").alias("id"), "text").where("doc_id is not null")
    found = _signature_rows(rows, size, containment, short, False).withColumnRenamed("id", "doc_id")
    pairs = stage(
        wanted.withColumnRenamed("id", "item_id").join(found, ["partition", "key"]).select("doc_id", "item_id").distinct(),
        "decon-pairs",
    )

    def grams(rows: DataFrame, all_lengths: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, out = [], []
                for row_id, text in zip(batch["id"], batch["text"], strict=True):
                    own = set(shingles(text, size))
                    for n in short if all_lengths else ():
                        own.update(_fixed(text, n))
                    ids.extend([row_id] * len(own))
                    out.extend(own)
                yield pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "gram": pd.Series(out, dtype=object)})

        return rows.mapInPandas(run, "id long, gram string")

    item_grams = grams(items.select(F.col("item_id").alias("id"), "text"), False).distinct().withColumnRenamed("id", "item_id")
    sizes = item_grams.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    doc_rows = rows.join(pairs.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    doc_grams = grams(doc_rows, True).distinct().withColumnRenamed("id", "doc_id")
    shared = (
        pairs.join(item_grams, "item_id").join(doc_grams, ["doc_id", "gram"]).groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_shared"))
    )
    enough = F.col("n_shared") >= F.greatest(F.lit(1), F.ceil(F.lit(containment) * F.col("n_shingles") - F.lit(1e-9)))
    return shared.join(sizes, "item_id").where(enough).select("doc_id", "item_id", "n_shingles", "n_shared")


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WORDS,
    containment: float = CONTAINMENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared``: the items of which a document holds at least ``containment``.

    Shingles are distinct runs of ``size`` words (letters, digits and
    underscore, lower-cased); an item of fewer words is one shingle of all its
    words; an item without words, a null text or a null item id matches nothing.
    Documents with a null id are left out, since a pair could not name them;
    ``clean_documents`` treats them by their text. Repeated documents or items
    give one pair (of repeated ids, the row that shares most counts). Other
    columns are ignored; an empty table on either side gives no rows.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null").distinct()
    # A word of an item takes about its own bytes in its shingle set five times over, and eight for its hash.
    if (items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) * 12 <= broadcast_bytes:
        found = _by_broadcast(rows, [(r["item_id"], r["text"]) for r in items.collect()], size, containment)
    else:
        found = _by_shuffle(rows, items, size, containment)
    pairs = found.where("doc_id is not null").groupBy("doc_id", "item_id")
    best = F.max(F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shared", "n_shingles")).alias("best")
    return pairs.agg(best).select("doc_id", "item_id", "best.n_shingles", "best.n_shared")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns stay.

    Rows are judged one by one by their text, so rows that share an id, or have none, are too.
    """
    key = "__text_key"
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    found = contained_items(marked.select(key, "text"), benchmark, id_column=key, **options)
    return marked.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
