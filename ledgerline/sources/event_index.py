"""Reconciled events as an append-only index, bucketed by event id.

Full reconciliation shuffles every event that ever arrived. The index keeps what
earlier runs found: rows ``(event_id, survivor)``, where ``survivor`` is the
struct by which :mod:`ledgerline.operators.events` ranks the copies of an event.
A run reads only the arrival days of the landing that changed, reduces them and the
batch delivery to one candidate per event, and appends the candidates that no
indexed row outranks (an anti join by id and rank). An event's row is the
least of its indexed rows, whichever run appended them.

The index is a bucketed Parquet table, one partition per run (``batch``). Joining
and reducing it by ``event_id`` needs no shuffle of the index; only candidates
move. A reader names the batches it trusts, so rows of a run that failed before
its version was published are never seen, and a repeated run appends nothing
twice that it can see. ``compact`` folds the batches into one.

Which days changed is decided by their row counts, which the landing's Parquet
footers hold: the landing only grows, so a day that received late or replayed
messages has another count, however old it is. ``replay_days`` are read again
in any case.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.events import align_stream, ranked, survivor_columns

#: Rows of the landing that a bucket of a new index is planned for, and how many buckets there are at least and most.
BUCKET_ROWS, BUCKETS, MOST_BUCKETS = 2_000_000, 8, 8192
#: The newest arrival days are read again by every run, changed or not.
REPLAY_DAYS = 2
#: Batches an event's rows may be spread over before they are folded into one.
MAX_BATCHES = 32


@dataclass
class IndexState:
    """What a published version knows: the index's batches, and the rows of each arrival day they cover."""

    batches: list[str] = field(default_factory=list)
    days: dict[str, int] = field(default_factory=dict)
    buckets: int = BUCKETS


def buckets_for(rows: int) -> int:
    """Buckets of an index that is started with so many rows in the landing; it keeps the number."""
    return max(BUCKETS, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))


class EventIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "ledgerline_events_" + hashlib.sha256(path.encode()).hexdigest()[:16]

    def _table(self, batches: list[str]) -> DataFrame:
        """The named batches as a bucketed table of this session's catalog; the files need no catalog of their own."""
        if not self.spark.catalog.tableExists(self.name):
            self.spark.sql(
                f"CREATE TABLE {self.name} (event_id STRING, survivor STRUCT<_source: INT, event_ts: STRING, "
                f"customer_id: STRING, type: STRING>, batch STRING) USING parquet PARTITIONED BY (batch) "
                f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        if batches:  # other sessions may have written them
            named = " ".join(f"PARTITION (batch='{b}')" for b in batches)
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {named}")
        return self.spark.table(self.name).where(F.col("batch").isin(batches))

    def best(self, batches: list[str]) -> DataFrame:
        """``event_id, survivor``: one row per event of the named batches. No shuffle."""
        return self._table(batches).groupBy("event_id").agg(F.min("survivor").alias("survivor"))

    def events(self, batches: list[str]) -> DataFrame:
        """The reconciled events of the named batches."""
        return survivor_columns(self.best(batches))

    def append(self, rows: DataFrame) -> str:
        """Write ``(event_id, survivor)`` as a new batch; its name."""
        self._table([])
        batch = uuid.uuid4().hex
        (
            rows.select("event_id", "survivor", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "event_id")  # one file per bucket
            .write.mode("append").format("parquet").partitionBy("batch")
            .bucketBy(self.buckets, "event_id").sortBy("event_id")
            .option("path", self.path).saveAsTable(self.name)
        )
        return batch

    def reconcile(
        self,
        batch_events: DataFrame,
        landing: DataFrame,
        state: IndexState,
        replay_days: int = REPLAY_DAYS,
        days: dict[str, int] | None = None,
    ) -> tuple[IndexState, list[str]]:
        """Bring the index up to date; the new state and the arrival days that were read.

        ``landing`` has its partition column ``arrival_date``; ``days`` are its
        ``day_counts``, if known. Rows without an id are not indexed (see
        ``operators.events.quarantine``).
        """
        days = day_counts(landing) if days is None else days
        read = days_to_read(days, state.days, replay_days)
        candidates = ranked(batch_events, align_stream(landing.where(arrived_on(read))))
        candidates = candidates.repartition(self.buckets, "event_id")  # as the index lies, whatever the session's default
        if state.batches:
            known = self.best(state.batches).withColumnRenamed("survivor", "known")
            candidates = candidates.join(known, "event_id", "left").where(
                F.col("known").isNull() | (F.col("survivor") < F.col("known"))
            )
        batches = [*state.batches, self.append(candidates)]
        if len(batches) > MAX_BATCHES:
            batches = [self.append(self.best(batches))]
        return IndexState(batches, days, self.buckets), read


def day_counts(landing: DataFrame) -> dict[str, int]:
    """Rows of each arrival day, from the Parquet footers (no column is read); bounded by the days of the landing."""
    counted = landing.groupBy(F.col("arrival_date").cast("string").alias("day")).count().collect()
    return {r["day"] or "": r["count"] for r in counted}


def days_to_read(days: dict[str, int], known: dict[str, int], replay_days: int = REPLAY_DAYS) -> list[str]:
    """Arrival days with another row count than is known, the newest ``replay_days``, and '' (messages without a time)."""
    dated = [d for d in days if d]
    newest = date.fromisoformat(max(dated)) if dated else date.min
    since = (newest - timedelta(days=replay_days - 1)).isoformat() if dated and replay_days else "9999-12-31"
    return sorted(d for d, n in days.items() if known.get(d) != n or d >= since or not d)


def arrived_on(days: list[str]) -> Column:
    """A partition filter on ``arrival_date``."""
    dated = F.col("arrival_date").isin([date.fromisoformat(d) for d in days if d])
    return F.coalesce(dated, F.lit(False)) | F.col("arrival_date").isNull() if "" in days else dated

