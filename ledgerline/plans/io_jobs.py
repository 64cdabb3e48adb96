"""Registered I/O and streaming jobs.

Each job maps the given test tables to raw datasets, runs a real write path
under a fresh folder inside the session's shared checkpoint folder, and returns
what it wrote, read back by Spark. The oracle SQL states what that read-back
must contain (the mapped data, or its row counts).
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import clean
from ledgerline.plans import refresh
from ledgerline.plans.catalog import Query
from ledgerline.schemas import EVENTS, PAYMENTS
from ledgerline.session import materialize, scratch_path
from ledgerline.sources import lake, raw, testdata
from ledgerline.sources.event_index import EventIndex, IndexState
from ledgerline.sources.expiry import expire_versions
from ledgerline.sources.lake import Layout
from ledgerline.streaming import landing

RUN_DATE = "2001-12-31"


def _layout(spark: SparkSession, label: str) -> Layout:
    return Layout(scratch_path(spark, label))


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments landed as CSV with a header, read back with the pinned schema."""
    path = scratch_path(spark, "csv") + "/payments"
    raw.write_csv(testdata.raw_payments(spark, sf_dir), path)
    return raw.read_csv_raw(spark, path, PAYMENTS)


def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events landed as JSON lines, read back with the pinned schema."""
    path = scratch_path(spark, "jsonl") + "/events"
    raw.write_jsonl(testdata.raw_events(spark, sf_dir), path)
    return raw.read_jsonl_raw(spark, path, EVENTS)


def bronze_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three run dates; one is rerun with other rows, one with none: only the last run of each stays."""
    layout = _layout(spark, "bronze-overwrite")
    payments = testdata.raw_payments(spark, sf_dir, testdata.written_payment_lines(spark, sf_dir))
    other = payments.withColumn("payment_id", F.concat(F.lit("old_"), "payment_id"))
    runs = [
        ("2001-12-29", payments), ("2001-12-30", other), (RUN_DATE, payments),
        ("2001-12-30", payments), ("2001-12-29", payments.limit(0)),
    ]
    for ds, rows in runs:
        lake.write_bronze(rows, layout, "payments", ds)
    landed = spark.read.parquet(layout.bronze("payments"))
    return landed.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count("*").alias("rows"), F.count_distinct("payment_id").alias("payment_ids")
    )


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven raw datasets ingested for one run date; rows per bronze table."""
    layout = _layout(spark, "bronze")
    refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir))
    parts = [
        lake.read_bronze(spark, layout, t, RUN_DATE).agg(F.lit(t).alias("table_name"), F.count("*").alias("rows"))
        for t in refresh.RAW_TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bronze_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and events landed with lines that do not fit; the lines as bronze rescued them, and the rows of each table.

    The seventh payment of an order has no number as its amount; events whose id
    ends in 7 are cut off within the JSON object.
    """
    layout, landed = _layout(spark, "rescued"), scratch_path(spark, "misfits")
    payments, event = testdata.raw_payments(spark, sf_dir), testdata.raw_events(spark, sf_dir)
    amount = F.when(F.col("payment_id").endswith("_7"), "n/a").otherwise(F.col("amount").cast("string"))
    raw.write_csv(payments.withColumn("amount", amount), f"{landed}/payments")
    cut = F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","customer_id'))
    whole = F.to_json(F.struct(*event.columns))
    event.select(F.when(F.col("event_id").endswith("7"), cut).otherwise(whole).alias("value")).write.text(f"{landed}/events")
    tables = dict(testdata.raw_tables(spark, sf_dir)) | {
        "payments": raw.read_csv_raw(spark, f"{landed}/payments", PAYMENTS, rescue=True),
        "events": raw.read_jsonl_raw(spark, f"{landed}/events", EVENTS, rescue=True),
    }
    rows = refresh.bronze_ingest(spark, layout, RUN_DATE, tables)
    parts = [
        lake.read_rescued(spark, layout, t, RUN_DATE).select(
            F.lit(t).alias("table_name"), F.col(raw.RESCUED).alias("line"), F.lit(rows[t]).cast("long").alias("bronze_rows")
        )
        for t in ("payments", "events")
    ]
    return parts[0].unionByName(parts[1])


def silver_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table written twice with different rows: the second run replaces the first."""
    layout = _layout(spark, "silver-snapshot")
    customers = testdata.raw_customers(spark, sf_dir)
    from ledgerline.operators.clean import clean_customers

    for rows in (customers.withColumn("customer_id", F.concat(F.lit("old_"), "customer_id")), customers):
        run = lake.new_run()
        entry = lake.write_silver(clean_customers(rows), layout, run, "customers")
        lake.publish_silver(spark, layout, run, RUN_DATE, {"customers": entry})
    return lake.read_silver(spark, layout, "customers")


def silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ingest + silver refresh (no stream landing: batch events only)."""
    layout = _layout(spark, "silver")
    refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir))
    refresh.silver_refresh(spark, layout, RUN_DATE)
    return lake.read_silver(spark, layout, "payments")


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments that a silver refresh rejected, as stored, with the rule."""
    layout = _layout(spark, "silver-rejects")
    refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir))
    refresh.silver_refresh(spark, layout, RUN_DATE)
    return lake.read_silver(spark, layout, "payments_rejected")


def events_batch_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events when the stream landing was never written: the batch copy alone.

    Looks for the landing of a fresh lake root (nothing there), takes the
    fallback, and returns the batch events (not deduplicated, as the fallback
    is specified).
    """
    from ledgerline.plans.catalog import Lake, LazyTables

    stream = refresh.read_stream_landing(spark, _layout(spark, "no-stream"))  # None: nothing landed
    raw_tables = LazyTables(testdata.RAW_TABLES, lambda t: testdata.raw_table(spark, sf_dir, t))
    return Lake(raw_tables, stream=stream).events


def _land_messages(spark: SparkSession, messages: DataFrame, layout: Layout) -> None:
    inbox = f"{layout.root}/inbox/{uuid.uuid4().hex[:8]}"
    raw.write_jsonl(messages, inbox)
    query = landing.land_events(landing.file_messages(spark, f"{layout.root}/inbox/*"), layout.stream_landing,
                                layout.stream_checkpoint)
    query.awaitTermination()


def stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages drained from an inbox by an availableNow streaming query."""
    layout = _layout(spark, "stream")
    _land_messages(spark, testdata.event_messages(spark, sf_dir), layout)
    return landing.read_landing(spark, layout.stream_landing).drop("raw_value")


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream landing + bronze + silver + published gold; the published fact."""
    layout = _layout(spark, "gold")
    _land_messages(spark, testdata.event_messages(spark, sf_dir), layout)
    refresh.full_refresh(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir), testdata.PASSING_GATES)
    return refresh.published_gold(spark, layout)["fct_payments"]


def events_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events reconciled in three runs, each reading only the arrival days that changed.

    A third of the arrival days lands before each run; before the second, the
    first third's messages are replayed. The batch delivery grows from run to
    run, so that copies of the stream are indexed before the batch's copy, which
    outranks them, arrives.
    """
    layout = _layout(spark, "events-incremental")
    messages, batch = testdata.event_messages(spark, sf_dir), testdata.raw_events(spark, sf_dir)
    day = F.pmod(F.datediff(F.to_date("timestamp"), F.lit("1970-01-01").cast("date")), F.lit(3))
    index, state = EventIndex(spark, layout.event_index, buckets=8), IndexState(buckets=8)
    for run in range(3):
        landed = messages.where(day == run)
        if run == 1:
            landed = landed.unionByName(messages.where(day == 0))
        _land_messages(spark, landed, layout)
        delivered = batch.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) <= run)
        state, _ = index.reconcile(delivered, refresh.read_stream_landing(spark, layout), state)
    return clean.clean_events(index.events(state.batches))


CHANGED_MONTH = "1997-03"


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes that differ in the amounts of one month: the published fact, and which refresh wrote each month."""
    layout = _layout(spark, "gold-incremental")
    tables = testdata.written_raw_tables(spark, sf_dir)
    in_month = F.col("created_at").startswith(CHANGED_MONTH)
    amount = F.when(in_month, F.col("amount") * 2).otherwise(F.col("amount"))
    payments = tables["payments"]
    versions = []
    for rows in (payments.withColumn("amount", amount).select(*payments.columns), payments):
        run = refresh.full_refresh(spark, layout, RUN_DATE, tables | {"payments": rows}, ("gold_fct_payments",))
        versions.append(run["gold_version"])
    written = lake.gold_manifest(spark, layout)["months"]
    second = [date.fromisoformat(m) for m, entry in written.items() if entry["version"] == versions[1]]
    by = F.when(F.col("date_month").isin(second), 2).otherwise(1).alias("written_by")
    return refresh.published_gold(spark, layout)["fct_payments"].select("*", by)


def versions_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes, the first without a month's payments, then an expiry while a reader holds the first version.

    Rows and digests of the fact as that reader still finds it and as the newest
    version has it once the first is gone, and how many versions stayed.
    """
    layout = _layout(spark, "expiry")
    tables = testdata.written_raw_tables(spark, sf_dir)
    payments = tables["payments"]
    without = payments.where(~F.coalesce(F.col("created_at").startswith(CHANGED_MONTH), F.lit(False)))
    log = lake.gold_log(spark, layout)
    refresh.full_refresh(spark, layout, RUN_DATE, tables | {"payments": without}, ("gold_fct_payments",))
    with log.holding() as first:
        refresh.full_refresh(spark, layout, RUN_DATE, tables, ("gold_fct_payments",))
        expire_versions(spark, layout, keep=1)
        held = refresh.published_gold(spark, layout, first)["fct_payments"].drop(lake.MONTH_COLUMN)
        held = materialize(_digest("held", held).withColumn("versions", F.lit(len(log.numbers()))), "expiry-held")
    expire_versions(spark, layout, keep=1)
    newest = refresh.published_gold(spark, layout)["fct_payments"].drop(lake.MONTH_COLUMN)
    return held.unionByName(_digest("newest", newest).withColumn("versions", F.lit(len(log.numbers()))))


MERGE_CUTS = ("1996-01-01", "1997-03-15")


def cohort_ltv_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort mart after three refreshes with ever more payments, and how many of them merged it.

    The second cut lies within a month, whose cells the last refresh builds anew.
    """
    layout = _layout(spark, "cohort-incremental")
    tables = testdata.written_raw_tables(spark, sf_dir)
    payments = tables["payments"]
    cuts = [F.coalesce(F.col("created_at") < cut, F.lit(True)) for cut in MERGE_CUTS]
    merged = 0
    for rows in (*(payments.where(cut) for cut in cuts), payments):
        refresh.full_refresh(spark, layout, RUN_DATE, tables | {"payments": rows}, ("gold_fct_payments",))
        merged += lake.gold_manifest(spark, layout)["cohort_months_read"] is not None
    return refresh.published_gold(spark, layout)["agg_cohort_ltv"].withColumn("merged_refreshes", F.lit(merged))


def _digest(table: str, df: DataFrame) -> DataFrame:
    """``table_name, rows, digest``: the digest adds up the first 32 bits of each row's MD5, columns in the order of their names."""

    def text(name: str, kind: str):
        column = F.col(name)
        if kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "double":
            column = column.cast("decimal(24,6)")
        return F.coalesce(column.cast("string"), F.lit("~"))

    row = F.concat_ws("|", *(text(c, t) for c, t in sorted(df.dtypes)))
    head = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long")
    return df.agg(
        F.lit(table).alias("table_name"), F.count("*").alias("rows"), F.coalesce(F.sum(head), F.lit(0)).alias("digest")
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven bronze tables of an ingest, as rows and digests of their contents."""
    layout = _layout(spark, "bronze-tables")
    refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir))
    parts = [_digest(t, lake.read_bronze(spark, layout, t, RUN_DATE).drop("_ingested_at")) for t in refresh.RAW_TABLES]
    return reduce(DataFrame.unionByName, parts)


def silver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All silver tables of one published version, as rows and digests of their contents."""
    layout = _layout(spark, "silver-tables")
    _land_messages(spark, testdata.event_messages(spark, sf_dir), layout)
    refresh.bronze_ingest(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir))
    refresh.silver_refresh(spark, layout, RUN_DATE)
    entries = lake.published_silver(spark, layout)
    return reduce(
        DataFrame.unionByName,
        [_digest(t, lake.read_silver_table(spark, layout, t, entry)) for t, entry in sorted(entries.items())],
    )


def gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables of a published gold version, as rows and digests of their contents."""
    layout = _layout(spark, "gold-tables")
    refresh.full_refresh(spark, layout, RUN_DATE, testdata.raw_tables(spark, sf_dir), testdata.PASSING_GATES)
    published = refresh.published_gold(spark, layout)
    return reduce(DataFrame.unionByName, [_digest(t, published[t]) for t in refresh.GOLD_TABLES])


IO_QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_jsonl": scan_jsonl,
    "bronze_partition_overwrite": bronze_partition_overwrite,
    "bronze_ingest": bronze_ingest,
    "bronze_rescued": bronze_rescued,
    "silver_snapshot": silver_snapshot,
    "silver_refresh": silver_refresh,
    "silver_rejects": silver_rejects,
    "events_batch_only": events_batch_only,
    "stream_land": stream_land,
    "gold_refresh": gold_refresh,
    "events_incremental": events_incremental,
    "gold_incremental": gold_incremental,
    "versions_expired": versions_expired,
    "cohort_ltv_incremental": cohort_ltv_incremental,
    "bronze_tables": bronze_tables,
    "silver_tables": silver_tables,
    "gold_tables": gold_tables,
}
