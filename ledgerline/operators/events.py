"""Account events: reconcile the batch file with the stream landing.

Both deliveries may carry the same ``event_id`` (the topic is replayed), so the
union keeps one row per id. The survivor is chosen deterministically: the batch
copy first, then the earliest timestamp, then the smallest remaining values.
``min(struct(...))`` is an ordinary aggregate, so each task collapses its own
duplicates before the shuffle and a replay storm on one id stays one row per
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import EVENTS

EVENT_COLUMNS = [f.name for f in EVENTS.fields]


def align_stream(stream_landing: DataFrame) -> DataFrame:
    """Keep the event columns of the stream landing (drop the arrival time)."""
    return stream_landing.select(*EVENT_COLUMNS)


def quarantine(batch: DataFrame, stream_landing: DataFrame) -> DataFrame:
    """Rows of either delivery without an id, which :func:`union_dedupe` cannot keep.

    ``source`` names the delivery; ``kafka_ts`` and ``raw_value`` are a message's
    arrival time and text. A batch row has no arrival time, and its ``raw_value``
    is the row as JSON. Repeated rows stay repeated.
    """
    lost = F.col("event_id").isNull()
    as_json = F.to_json(F.struct(*EVENT_COLUMNS)).alias("raw_value")
    from_batch = batch.where(lost).select(F.lit("batch").alias("source"), *EVENT_COLUMNS, as_json)
    from_stream = stream_landing.where(lost).select(F.lit("stream").alias("source"), "*")
    return from_stream.unionByName(from_batch, allowMissingColumns=True)


def ranked(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Union by name (missing columns become NULL): ``event_id, survivor``, the struct of the copy that stays.

    Copies are ranked by that struct: the least one stays.
    """
    both = batch.withColumn("_source", F.lit(0)).unionByName(
        align_stream(stream).withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    survivor = F.min(F.struct("_source", "event_ts", "customer_id", "type")).alias("survivor")
    return both.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(survivor)


def survivor_columns(rows: DataFrame) -> DataFrame:
    """Events from :func:`ranked` rows."""
    return rows.select("event_id", "survivor.customer_id", "survivor.type", "survivor.event_ts")


def union_dedupe(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Both deliveries with one row per ``event_id``."""
    return survivor_columns(ranked(batch, stream))
