"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into ``max_bits // 2 + 1`` segments (three for four bits).
Two fingerprints within ``max_bits`` differ by at most one bit in some segment,
so each fingerprint looks up its segment value and the ball of radius one
around it in the table of that segment. Of a pair whose segment differs in one
bit, exactly one side has a zero there: balls are enumerated upward only (zero
bits set), which halves the look-ups and loses none. Matches are verified by
the complete distance.

Look-ups meet in shards by the hash of (segment, value). Within a shard each
bucket is compared with NumPy and only a spanning forest of its links leaves
the task, so output is linear even where thousands of near copies meet. A
bucket with more than ``bucket_rows`` entries is not compared in one task: its
fingerprints emit every point within ``max_bits / 2`` bits, and those that
share a point are linked to the smallest of them, which is exact, linear in
the bucket and spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, bound_batches, local_roots, stage, text_bytes
from ledgerline.llm.components import connected_components

SEED = 42
#: Rows of probes that one shard task handles (its expected number; buckets beyond bucket_rows are taken out).
SHARD_ROWS = 100_000
#: Pairs compared at once within a task.
PAIR_CHUNK = 1 << 20

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_WEIGHTS = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every ``size``-word shingle (fewer words: the whole sequence; none: empty)."""
    words = ascii_lower(text).split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    return np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)),
        np.uint64,
        len(starts),
    )


def fingerprint(text: bytes, size: int) -> int:
    """64-bit SimHash: a bit is one if it is set in over half of the shingle hashes."""
    h = shingle_hashes(text, size)
    if not len(h):
        return 0
    columns = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, j], minlength=256) @ _BYTE_BITS for j in range(8)])
    return int(_WEIGHTS[2 * ones > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, fp, text_md5)``: one signed 64-bit fingerprint per row; a null text is empty."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(text_bytes(t.as_py()), size) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)], names=["doc_id", "fp", "text_md5"]
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        _text_md5(text_column).alias("text_md5"),
    )
    return rows.mapInArrow(run, "doc_id long, fp long, text_md5 binary")


def _text_md5(text_column: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment: enough of them that some segment differs by one bit at most."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _segment_entries(seg: int, key: Column, width: int) -> list[Column]:
    def entry(value: Column, own: bool) -> Column:
        return F.struct(F.lit(seg).alias("seg"), value.alias("key"), F.lit(own).alias("own"))

    ball = F.array(*(F.lit(1 << j).cast("long") for j in range(width)))
    free = F.filter(ball, lambda bit: key.bitwiseAND(bit) == 0)
    return [F.array(entry(key, True)), F.transform(free, lambda bit: entry(key.bitwiseOR(bit), False))]


def _lookups(prints: DataFrame, max_bits: int) -> DataFrame:
    """(seg, key, own, fp): the segment's own value, and the values with one more bit set."""
    entries = []
    for seg, (shift, width) in enumerate(segments(max_bits)):
        entries += _segment_entries(seg, F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)), width)
    return prints.select("fp", F.explode(F.concat(*entries)).alias("e")).select("e.*", "fp")


def _pairs(own: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (index into own, index into other), in chunks."""
    step = max(1, PAIR_CHUNK // max(1, len(other)))
    for i in range(0, len(own), step):
        left = np.arange(i, min(i + step, len(own)))
        yield np.repeat(left, len(other)), np.tile(np.arange(len(other)), len(left))


def _bucket_links(max_bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["seg", "key"], kind="stable")
        bucket = (rows["seg"].to_numpy().astype(np.int64) << 58) | rows["key"].to_numpy()
        values, node = np.unique(rows["fp"].to_numpy(), return_inverse=True)
        own = rows["own"].to_numpy()
        bits = values.view(np.uint64)
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[at, len(bucket)])
        first, second = [], []
        for a, n in zip(at[sizes > 1], sizes[sizes > 1], strict=True):
            here, mine = node[a : a + n], own[a : a + n]
            table, balls = here[mine], here[~mine]
            if not len(table) or n < 2:
                continue
            got_a, got_b = [], []
            for left, right in ((table, table), (table, balls)):
                for i, j in _pairs(left, right):
                    x, y = left[i], right[j]
                    near = (np.bitwise_count(bits[x] ^ bits[y]) <= max_bits) & (x != y)
                    got_a.append(x[near])
                    got_b.append(y[near])
            x, y = np.concatenate(got_a), np.concatenate(got_b)
            if len(x):  # only a forest of the bucket's links leaves the task
                some, local = np.unique(np.r_[x, y], return_inverse=True)
                root = local_roots(local[: len(x)], local[len(x) :], len(some))
                move = root != np.arange(len(some))
                first.append(some[move])
                second.append(some[root[move]])
        a = np.concatenate(first) if first else np.empty(0, np.int64)
        b = np.concatenate(second) if second else np.empty(0, np.int64)
        return pd.DataFrame({"a": values[a], "b": values[b]})

    return run


def _point_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links of fingerprints that share a point within ``max_bits // 2`` bits of both.

    Exact for even ``max_bits``: such fingerprints are at most ``max_bits`` apart,
    and any two that close share the points half way.
    """
    masks = [0]
    for r in range(1, max_bits // 2 + 1):
        masks += [sum(1 << j for j in bits) for bits in combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    points = prints.select("fp", F.explode(F.lit(signed)).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("p"))
    low = points.groupBy("p").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("p", "b")
    low = stage(low, "simhash-points")
    return points.join(low, "p").where("fp != b").select(F.col("fp").alias("a"), "b").distinct()


def near_links(prints: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all pairs within ``max_bits``."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: hot buckets meet half way")
    lookups = _lookups(prints, max_bits)
    sizes = lookups.groupBy("seg", "key").agg(F.count("*").alias("n"))
    hot = stage(sizes.where(F.col("n") > bucket_rows).select("seg", "key"), "simhash-hot")
    n_hot, n_prints = hot.count(), prints.count()
    cold = lookups.join(hot, ["seg", "key"], "left_anti") if n_hot else lookups
    shards = max(1, -(-n_prints * 40 // SHARD_ROWS))
    links = (
        cold.withColumn("shard", F.pmod(F.xxhash64("seg", "key"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(_bucket_links(max_bits), "a long, b long")
    )
    if n_hot:
        crowded = lookups.join(hot, ["seg", "key"], "left_semi").select("fp").distinct()
        links = links.unionByName(_point_links(crowded, max_bits))
    return links


def simhash_groups(
    docs: DataFrame,
    shingle_words: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_rows: int = 4096,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, its own included. Null text counts as empty
    (fingerprint zero, linked like any other). Rows with a null id get a
    fingerprint and take part in linking; their component is the smallest
    non-null id of the group, or null if there is none. Repeated rows stay.
    Other columns of ``docs`` are ignored; an empty table gives no rows.
    """
    rows = stage(fingerprints(docs, shingle_words, id_column, text_column).drop("text_md5"), "simhash-prints")
    labelled = _labelled(rows, max_bits, bucket_rows)
    lows = stage(labelled.groupBy("component").agg(F.min("low").alias("component_id")), "simhash-lows")
    classes = stage(labelled.join(lows, "component").select("fp", "component_id"), "simhash-classes")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labelled(rows: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """``fp, low, component``: each fingerprint, the smallest id that has it, the smallest fingerprint of its component."""
    # Equal fingerprints are one node: the minimum is combined before the shuffle, however many copies there are.
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    parts = connected_components(near_links(nodes.select("fp"), max_bits, bucket_rows), "simhash")
    labelled = nodes.join(parts, nodes["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component")
    )
    return stage(labelled, "simhash-labelled")


def one_per_group(
    docs: DataFrame,
    shingle_words: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_rows: int = 4096,
) -> DataFrame:
    """The rows of ``docs`` with one row of each SimHash group, all columns kept.

    The row with the smallest id stays, rows without an id coming after all
    others; of several texts of that id, the one with the least MD5. Groups are
    told apart by their fingerprints, not by ids: rows that share an id but not
    a group are judged each in its own group. Of rows equal in id and text (null
    and empty texts are equal) one stays; if they differ in other columns, any.
    An empty table gives no rows.
    """
    rows = stage(fingerprints(docs, shingle_words, id_column, text_column), "simhash-prints")
    labelled = _labelled(rows, max_bits, bucket_rows)
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_md5")
    first = rows.join(labelled.select("fp", "component"), "fp").groupBy("component").agg(F.min(place).alias("first"))
    kept = stage(first.select(F.col("first.doc_id").alias("i"), F.col("first.text_md5").alias("m")), "simhash-kept")
    mark = next(c for c in ("_" * n + "text_md5" for n in count(2)) if c not in docs.columns)
    marked = docs.withColumn(mark, _text_md5(text_column))
    same = marked[id_column].cast("long").eqNullSafe(kept["i"]) & (marked[mark] == kept["m"])
    return marked.join(kept, same, "left_semi").dropDuplicates([id_column, mark]).drop(mark)
