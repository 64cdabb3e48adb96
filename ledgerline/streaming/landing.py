"""Structured Streaming landing of the account-event topic.

Messages are ``(value, timestamp)`` pairs: the event as a JSON object and the
arrival time. The landing parses each message into the four event columns plus
``kafka_ts`` and appends them as Parquet, checkpointed, draining whatever is
available and stopping (``availableNow``). A malformed message parses to an
all-NULL event and is still landed; silver quarantines it.

In deployments the source is the broker (``format("kafka")`` with
``subscribe``, ``startingOffsets=earliest``, ``failOnDataLoss=false``); tests
and local runs read the same messages from a directory of JSON-lines files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ledgerline.schemas import EVENTS

MESSAGE_SCHEMA = StructType(
    [StructField("value", StringType(), True), StructField("timestamp", TimestampType(), True)]
)


def parse_messages(messages: DataFrame) -> DataFrame:
    """``(value, timestamp)`` -> ``event_id, customer_id, type, event_ts, kafka_ts``.

    Works on batch and streaming DataFrames alike; ``value`` may be binary (the
    broker) or text. PERMISSIVE parsing: bad JSON yields NULL fields.
    """
    return _parse(messages).select(*EVENTS.fieldNames(), "kafka_ts")


def _parse(messages: DataFrame) -> DataFrame:
    """The parsed event, its arrival time and, where it has no id, the message as it came (``raw_value``)."""
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.from_json(text, EVENTS).alias("event"), F.col("timestamp").alias("kafka_ts"), text.alias("text")
    )
    return parsed.select("event.*", "kafka_ts", F.when(F.col("event.event_id").isNull(), F.col("text")).alias("raw_value"))


# Upper bound on one micro-batch: a backlog is drained as several bounded
# batches (availableNow honours these limits) instead of one giant batch.
MAX_OFFSETS_PER_BATCH = 5_000_000
MAX_FILES_PER_BATCH = 1_000


def broker_messages(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """The topic as a stream of messages (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", MAX_OFFSETS_PER_BATCH)
        .load()
        .select("value", "timestamp")
    )


def file_messages(spark: SparkSession, inbox: str) -> DataFrame:
    """Messages dropped as JSON-lines files ``{"value": ..., "timestamp": ...}`` in ``inbox``."""
    from ledgerline.sources.raw import JSON_TIMESTAMP

    return (
        spark.readStream.option("timestampFormat", JSON_TIMESTAMP)
        .option("maxFilesPerTrigger", MAX_FILES_PER_BATCH)
        .schema(MESSAGE_SCHEMA)
        .json(inbox)
    )


def land_events(messages: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append parsed events to ``output`` as Parquet, drain what is there, stop.

    The checkpoint records consumed offsets and the sink's file log, so a rerun
    without new messages writes nothing and a restarted run resumes where the
    last committed batch ended. The landing is partitioned by arrival day; a
    message without an id keeps its text in ``raw_value``.
    """
    parsed = _parse(messages).withColumn("arrival_date", F.to_date("kafka_ts"))
    return (
        parsed.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .partitionBy("arrival_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_landing_days(spark: SparkSession, output: str) -> DataFrame:
    """The landed events with their partition column ``arrival_date`` (the sink's file log lists only committed files)."""
    landed = spark.read.parquet(output)
    if "raw_value" in landed.columns:
        return landed
    return landed.withColumn("raw_value", F.lit(None).cast("string"))  # landed before it was kept


def read_landing(spark: SparkSession, output: str) -> DataFrame:
    """The landed events."""
    return read_landing_days(spark, output).drop("arrival_date")
