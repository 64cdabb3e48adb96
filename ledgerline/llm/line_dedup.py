"""Line deduplication over levelled sorted runs of line hashes.

State is a set of immutable runs, each a Parquet table of ``(h1, h2, n_docs,
keeper)`` rows bucketed and sorted by the hash: in how many documents of a batch
a line occurs, and the largest document id among them. Each new batch is
merge-anti-joined with the runs before it, bucket by bucket and without moving
them: a line that no run holds enters the batch's own run with its keeper; of a
line that a run holds with a larger keeper, only the count enters, as the
batch holds none of its kept copies. When a level has ``fanout`` runs they are
merged into one run of the next level, so a line's state is spread over a
logarithmic number of runs and each row is rewritten once per level. The levels
are published as numbered manifests, from which a later job takes the runs up.

A line's hash is XXH3-128 of its key, held as two longs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import ASCII_SPACE, ascii_lower, bound_batches, stage
from ledgerline.session import scratch_path
from ledgerline.sources.versions import VersionLog

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches in which a whole table is fed, and runs of a level before they are merged.
BATCHES = 4
FANOUT = 3
#: Lines (with repeats) that a bucket of the runs is planned for; there are at least ``BUCKETS``.
BUCKET_LINES, BUCKETS = 1_000_000, 8

RUN_SCHEMA = "h1 long, h2 long, n_docs long, keeper long"


def line_hash(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None if the key is shorter than ``min_chars`` code points."""
    key = line.strip(ASCII_SPACE)
    if len(key) < min_chars:
        return None
    return xxhash.xxh3_128_digest(ascii_lower(key.encode("utf-8", "surrogatepass")))


def line_hashes(docs: DataFrame, min_chars: int, id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, h1, h2)``: the distinct long lines of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {h for line in (text or "").split("\n") if (h := line_hash(line, min_chars))}
                ids.extend([doc_id] * len(found))
                hashes.extend(found)
            halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["doc_id", "h1", "h2"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, h1 long, h2 long")


def buckets_for(lines: int) -> int:
    """Buckets of runs that are started for so many lines; they keep the number."""
    return max(BUCKETS, -(-lines // BUCKET_LINES))


class LineRuns:
    """Levelled sorted runs under ``root``; ``levels[i]`` names the runs of level ``i``, oldest first.

    The newest manifest under ``root`` tells the levels, the fanout and the number
    of buckets, so a later job continues where the last one published; without
    one, the runs start empty. One job at a time adds to a root.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, root: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root or scratch_path(spark, "llm-line-runs")
        self.log = VersionLog(spark, self.root)
        known = self.log.latest() or {"levels": [], "fanout": fanout, "buckets": buckets}
        self.levels: list[list[str]] = known["levels"]
        self.fanout, self.buckets = known["fanout"], known["buckets"]

    def _table(self, run: str) -> DataFrame:
        """A run as a bucketed table of this session's catalog; the files need no catalog of their own."""
        name = f"ledgerline_lines_{run}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} (h1 LONG, h2 LONG, n_docs LONG, keeper LONG) USING parquet "
                f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{run}'"
            )
        return self.spark.table(name)

    def _rows(self, run: str) -> DataFrame:
        """A run as plain files, for unions: over bucketed tables, Spark 4.1 leaves out the shuffle after a union and
        then reads the tables unbucketed, which loses counts."""
        return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/{run}")

    def _write(self, rows: DataFrame) -> str:
        """Write rows, which lie in the buckets' partitions, as a run; its name."""
        run = uuid.uuid4().hex
        (
            rows.select("h1", "h2", "n_docs", "keeper")
            .write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.root}/{run}").saveAsTable(f"ledgerline_lines_{run}")
        )
        return run

    def _forget(self, runs: list[str]) -> None:
        """Delete runs that no manifest names any more."""
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS ledgerline_lines_{run}")
            self.log.delete_folder(run)

    def anti_joined(self, batch: DataFrame) -> DataFrame:
        """``h1, h2, n_docs, keeper`` of a batch, with a keeper only where no run has a larger one.

        A chain of merge joins, one per run; only the batch moves, to the buckets.
        """
        rows = batch.repartition(self.buckets, "h1", "h2")
        for run in self.runs():
            known = self._table(run).select("h1", "h2", F.coalesce("keeper", F.lit(None).cast("long")).alias("known"))
            rows = rows.join(known.hint("merge"), ["h1", "h2"], "left")
            outranked = F.coalesce(F.col("known") >= F.col("keeper"), F.lit(False))
            rows = rows.withColumn("keeper", F.when(~outranked, F.col("keeper"))).drop("known")
        return rows

    def add(self, lines: DataFrame) -> None:
        """Add a batch's ``(doc_id, h1, h2)`` as a run. A document's rows must all be in one batch."""
        distinct = lines.where("doc_id is not null").distinct()
        batch = distinct.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        run, level, merged = self._write(self.anti_joined(batch)), 0, []
        while True:
            while len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                break
            rows = self.merged([self._rows(r) for r in self.levels[level]])
            run = self._write(rows.repartition(self.buckets, "h1", "h2"))
            merged += self.levels[level]
            self.levels[level] = []
            level += 1
        self.log.publish({"levels": self.levels, "fanout": self.fanout, "buckets": self.buckets})
        self._forget(merged)

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        """One row per line over several runs."""
        rows = reduce(DataFrame.unionByName, runs)
        if len(runs) == 1:
            return rows
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def state(self) -> DataFrame:
        """``h1, h2, n_docs, keeper``: one row per line of all batches."""
        runs = [self._rows(run) for run in self.runs()]
        return self.merged(runs) if runs else self.spark.createDataFrame([], RUN_SCHEMA)

    def screen(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """``(doc_id, h1, h2)`` of a batch that the runs reject: frequent, and kept by another document.

        A null id never keeps a line.
        """
        frequent = self.state().where(F.col("n_docs") >= min_docs)
        frequent = stage(frequent.select("h1", "h2", "keeper"), "lines-frequent")
        return (
            lines.join(frequent, ["h1", "h2"])
            .where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("keeper")))
            .select("doc_id", "h1", "h2")
        )


def _drop_lines(docs: DataFrame, rejected: DataFrame, min_chars: int, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with the rejected lines cut from the text, and ``n_lines``, ``n_dropped`` appended."""
    per_doc = rejected.distinct().groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("h1", "h2")).alias("__drop")
    )
    columns = docs.columns
    joined = docs.join(per_doc, F.col(id_column).cast("long").eqNullSafe(F.col("__id")), "left").select(
        *(F.col(c) for c in columns), "__drop"
    )
    at = columns.index(text_column)
    schema = docs.select(*columns).schema.add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if drop:
                    gone = {np.array([d["h1"], d["h2"]], "<i8").tobytes() for d in drop}
                    kept = [x for x in lines if line_hash(x, min_chars) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                texts.append(text if len(kept) == len(lines) else "\n".join(kept))
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=schema.names
            )

    return joined.mapInArrow(run, schema)


def line_dedup(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All columns of ``docs`` with repeated lines cut from the text, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. Keys of at least ``min_chars`` code points in at least
    ``min_docs`` documents stay only in the document with the largest id that
    holds them; all other lines stay, joined by a newline. A null or empty text
    is one empty line; a null text that loses nothing stays null. Rows that
    share a doc_id are one document: counted once, kept or cut alike. Rows with
    a null id are not counted and keep no frequent line. Columns
    named ``n_lines``, ``n_dropped``, ``__id`` or ``__drop`` are replaced or left
    out. An empty table gives no rows.

    The table is fed in ``batches``, ranges of the id from the largest down, so the
    anti-join with the runs settles as a batch arrives which lines it may keep.
    Whether a line is frequent is known once all batches are in, because the rule
    counts documents of the whole table.
    """
    bound_batches(docs.sparkSession)
    docs = _fresh(docs)
    lines = stage(line_hashes(docs, min_chars, id_column, text_column), "lines")
    runs = LineRuns(docs.sparkSession, fanout, buckets=buckets_for(lines.count()))
    for in_range in _ranges(docs, batches, id_column):
        runs.add(lines.where(in_range))
    rejected = stage(runs.screen(lines, min_docs), "lines-rejected")
    return _drop_lines(docs, rejected, min_chars, id_column, text_column)


def _ranges(docs: DataFrame, batches: int, id_column: str) -> list[Column]:
    """Conditions on ``doc_id`` that split the ids into ranges of about as many rows, the largest ids first."""
    cuts = F.percentile_approx(F.col(id_column).cast("long"), [i / batches for i in range(1, batches)], 1000)
    bounds = sorted(set(docs.agg(cuts.alias("cuts")).first()["cuts"] or []), reverse=True) if batches > 1 else []
    doc_id, above = F.col("doc_id"), F.lit(True)
    ranges = []
    for bound in bounds:
        ranges.append(above & (doc_id > bound))
        above = doc_id <= bound
    return [*ranges, above]


def _fresh(docs: DataFrame) -> DataFrame:
    """Drop columns whose names the operator adds itself."""
    return docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped", "__id", "__drop")])


def sha256_hex(text: str | None) -> str:
    """Lower-case hex SHA-256 of a text's UTF-8 (used by tests)."""
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest()
