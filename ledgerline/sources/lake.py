"""Lake layout and layer I/O: bronze partitions, silver snapshots, versioned gold.

* Bronze: one Parquet partition per run date ``dt=<ds>``; a rerun overwrites
  only its own partition folder, siblings are untouched.
  Every row carries ``_ingested_at``.
* Silver: a run writes its tables into folders of its own and publishes them
  together as one numbered version (:mod:`ledgerline.sources.versions`). A run
  that fails midway leaves the version before it whole. Payments are written once,
  by outcome: the kept ones, and those each rule rejects. Quarantined events are
  stored by arrival day, events as an index
  (:mod:`ledgerline.sources.event_index`). Payments are recomputed by each run from
  that day's bronze, and gold clusters them by month: a month-wise silver would
  cost a shuffle of all payments more.
* Gold: likewise one version of six tables. The fact is stored by month, and a
  version refers to the months that did not change since the one before it.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from ledgerline.operators import clean
from ledgerline.operators.enrich import DROP_RULES, KEPT, OUTCOME
from ledgerline.schemas import RAW_SCHEMAS
from ledgerline.session import CODEC
from ledgerline.sources.event_index import EventIndex, IndexState
from ledgerline.sources.raw import RESCUED
from ledgerline.sources.versions import NULL_SLICE, VersionLog, read_slices, write_slices, written_slices


@dataclass(frozen=True)
class Layout:
    """Paths of every layer under one root (any Hadoop-compatible URI)."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def silver_run(self, run: str, table: str) -> str:
        """A table that a run writes as a whole."""
        return f"{self.silver}/run={run}/{table}"

    def silver_sliced(self, table: str) -> str:
        """A table whose slices the versions share."""
        return f"{self.silver}/{table}"

    @property
    def event_index(self) -> str:
        return f"{self.silver}/events_index"

    @property
    def gold_root(self) -> str:
        return f"{self.root}/gold"

    def gold(self, version: str, table: str) -> str:
        """A gold table of a version; of a table stored by month, the folder that all versions share."""
        return f"{self.gold_root}/{table}" if table in GOLD_PARTITIONS else f"{self.gold_root}/v={version}/{table}"

    @property
    def stream_landing(self) -> str:
        return f"{self.root}/bronze/events_stream"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.root}/_checkpoints/events_stream"


# ---- bronze ----------------------------------------------------------------


def write_bronze(df: DataFrame, layout: Layout, table: str, ds: str) -> str:
    """Stamp ``_ingested_at`` and replace partition ``dt=<ds>`` as a whole.

    The partition's own folder is overwritten, so a rerun with an empty dataset
    leaves it empty instead of keeping the old rows.
    """
    path = layout.bronze(table)
    df.withColumn("_ingested_at", F.current_timestamp()).write.mode("overwrite").option("compression", CODEC).parquet(
        f"{path}/dt={ds}"
    )
    return path


def bronze_schema(table: str) -> StructType | None:
    """Raw schema + ``_ingested_at`` + partition ``dt`` for the seven raw tables."""
    raw = RAW_SCHEMAS.get(table)
    if raw is None:
        return None
    return StructType(
        [StructField(f.name, f.dataType, True) for f in raw.fields]
        + [StructField("_ingested_at", TimestampType(), True), StructField("dt", StringType(), True)]
    )


def read_bronze(spark: SparkSession, layout: Layout, table: str, ds: str) -> DataFrame:
    """Exactly one run's partition; a run date that was never ingested fails (PATH_NOT_FOUND).

    Known tables are read with their schema, never inferred.
    """
    schema = bronze_schema(table)
    reader = spark.read if schema is None else spark.read.schema(StructType([f for f in schema if f.name != "dt"]))
    return reader.parquet(f"{layout.bronze(table)}/dt={ds}")


def read_rescued(spark: SparkSession, layout: Layout, table: str, ds: str) -> DataFrame:
    """Rows of a run's partition whose line did not fit the raw schema, with that line as ``_rescued``.

    They are stored with the table, so one write keeps both; row groups
    without any are skipped by their statistics. Partitions written without the
    column have none.
    """
    fields = [f for f in bronze_schema(table) if f.name != "dt"] + [StructField(RESCUED, StringType(), True)]
    rows = spark.read.schema(StructType(fields)).parquet(f"{layout.bronze(table)}/dt={ds}")
    return rows.where(F.col(RESCUED).isNotNull())


# ---- silver ----------------------------------------------------------------

MONTH_COLUMN = "date_month"
DAY_COLUMN = "arrival_date"


def new_run() -> str:
    """A name for one run's folders; versions are ordered by their manifests, not by it."""
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]


@dataclass
class SilverTable:
    """Where a version keeps a table: a folder, slices of a shared folder, or batches of the event index.

    ``path`` is a table's own folder, or the shared folder of its slices if that has another name than the table.
    """

    schema: dict
    path: str | None = None
    slice_column: str | None = None
    slices: dict[str, str] | None = None
    index: dict | None = None


def write_silver(df: DataFrame, layout: Layout, run: str, table: str) -> SilverTable:
    """Write one silver table into an unpublished run; its entry of the manifest."""
    schema = df.schema.jsonValue()
    path = layout.silver_run(run, table)
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return SilverTable(schema, path=path)


#: Rejected payments keep their own columns, and the rule.
REJECTED_PRICE = [
    "fx_rate_to_usd", "amount_usd", "chargeback_reason_code", "chargeback_filed_at", "has_chargeback",
]


def write_outcomes(df: DataFrame, layout: Layout, run: str) -> dict[str, SilverTable]:
    """Kept and rejected payments in one write, a slice per outcome; the entries of both tables."""
    root = layout.silver_sliced("payments")
    write_slices(df, root, OUTCOME, run)
    slices = {outcome: run for outcome in written_slices(df.sparkSession, root, OUTCOME, run)}
    kept = {outcome: run for outcome in slices if outcome == KEPT}
    rejected = {outcome: run for outcome in slices if outcome != KEPT}
    return {
        "payments": SilverTable(df.drop(OUTCOME).schema.jsonValue(), root, OUTCOME, kept),
        "payments_rejected": SilverTable(df.drop(*REJECTED_PRICE).schema.jsonValue(), root, OUTCOME, rejected),
    }


def outcome_counts(spark: SparkSession, layout: Layout, written: dict[str, SilverTable]) -> dict[str, int]:
    """Written payments by outcome, from the footers of the files; one row per outcome reaches the driver."""
    rejected = read_silver_table(spark, layout, "payments_rejected", written["payments_rejected"])
    counts = {rule: 0 for rule in DROP_RULES}
    counts |= {r[OUTCOME]: r["count"] for r in rejected.groupBy(OUTCOME).count().collect()}
    return counts | {KEPT: read_silver_table(spark, layout, "payments", written["payments"]).count()}


def write_quarantine(df: DataFrame, layout: Layout, run: str, read_days: list[str], before: SilverTable | None) -> SilverTable:
    """Quarantined events by arrival day: those of the days read anew, and the batch's (no day); other days stay as they were."""
    root = layout.silver_sliced("events_quarantine")
    schema = df.drop(DAY_COLUMN).schema.jsonValue()
    write_slices(df, root, DAY_COLUMN, run)
    written = written_slices(df.sparkSession, root, DAY_COLUMN, run)
    kept = dict(before.slices or {}) if before else {}
    for day in (*read_days, NULL_SLICE):
        kept.pop(day, None)
    return SilverTable(schema, slice_column=DAY_COLUMN, slices=kept | {d: run for d in written})


def silver_log(spark: SparkSession, layout: Layout) -> VersionLog:
    return VersionLog(spark, layout.silver)


def publish_silver(spark: SparkSession, layout: Layout, run: str, ds: str, tables: dict[str, SilverTable]) -> int:
    """Make the tables of a run the current silver, all at once; its version number."""
    return silver_log(spark, layout).publish(
        {"run": run, "ds": ds, "tables": {name: asdict(table) for name, table in tables.items()}}
    )


def published_silver(spark: SparkSession, layout: Layout, number: int | None = None) -> dict[str, SilverTable]:
    """The tables of the newest (or a given) silver version; none before the first."""
    log = silver_log(spark, layout)
    return silver_tables(log.latest() if number is None else log.read(number))


def silver_tables(manifest: dict | None) -> dict[str, SilverTable]:
    """The tables that a manifest names; none without one."""
    return {name: SilverTable(**entry) for name, entry in (manifest or {"tables": {}})["tables"].items()}


def read_silver_table(spark: SparkSession, layout: Layout, table: str, entry: SilverTable) -> DataFrame:
    """A table of a version."""
    schema = StructType.fromJson(entry.schema)
    if entry.index is not None:
        state = IndexState(**entry.index)
        return clean.clean_events(EventIndex(spark, layout.event_index, state.buckets).events(state.batches))
    if entry.slices is not None:
        root, kind = entry.path or layout.silver_sliced(table), StringType() if entry.slice_column == OUTCOME else DateType()
        df = read_slices(spark, root, entry.slice_column, kind, entry.slices, schema)
        return df.select(*schema.names)
    return spark.read.schema(schema).parquet(entry.path)


def read_silver(spark: SparkSession, layout: Layout, table: str, number: int | None = None) -> DataFrame:
    """A table of the newest (or a given) silver version."""
    return read_silver_table(spark, layout, table, published_silver(spark, layout, number)[table])


# ---- gold ------------------------------------------------------------------

# Date-partitioned gold tables: table -> (date column, secondary sort key).
GOLD_PARTITIONS = {"fct_payments": ("date_key", "payment_id")}


def prepare_gold(df: DataFrame, table: str) -> DataFrame:
    """A gold table as it is written.

    A date-partitioned table is rebalanced on its month: rows of one month
    meet in the same tasks, so each task writes files for few months (file
    count near data size / advisory size + months, not tasks x months);
    adaptive execution splits a month holding a large share of the rows into
    advisory-size tasks and coalesces small months. Unlike a range partitioning
    it needs no sampling pass over the input. Within each task rows are sorted
    by (day, key), so every file covers a narrow range of days and Parquet
    min/max statistics skip files for day filters.

    Without adaptive execution a rebalance cannot split a hot month, so the
    table is range-partitioned on (day, key) instead: a sampling pass, but a
    heavy month or day is still spread over many tasks.
    """
    if table not in GOLD_PARTITIONS:
        return df
    day, key = GOLD_PARTITIONS[table]
    with_month = df.withColumn(MONTH_COLUMN, F.trunc(day, "MM"))
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        clustered = with_month.hint("rebalance", MONTH_COLUMN)
    else:
        clustered = with_month.repartitionByRange(day, key)
    return clustered.sortWithinPartitions(day, key)


def month_prints(fct: DataFrame) -> dict[str, dict]:
    """Per month of a date-partitioned table: its rows and two sums of 64-bit row hashes, independent of row order.

    One aggregate; as many rows reach the driver as there are months. The upper
    and lower halves of the hashes are summed apart, as long integers.
    """
    columns = [c for c in fct.columns if c != MONTH_COLUMN]
    day = GOLD_PARTITIONS["fct_payments"][0]
    hashes = [F.xxhash64(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)]
    sums = [
        part
        for h in ("h1", "h2")
        for part in (
            F.sum(F.shiftright(h, 32)).alias(f"{h}_upper"),
            F.sum(F.col(h).bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{h}_lower"),
        )
    ]
    hashed = fct.select(F.trunc(day, "MM").alias("month"), *hashes)
    rows = hashed.groupBy("month").agg(F.count("*").alias("n"), *sums).withColumn("month", F.col("month").cast("string"))
    return {
        r["month"]: {"rows": r["n"], "print": [str((r[f"{h}_upper"] << 32) + r[f"{h}_lower"]) for h in ("h1", "h2")]}
        for r in rows.collect()
    }


def write_gold(df: DataFrame, layout: Layout, version: str, table: str) -> str:
    """Write one gold table into an unpublished version."""
    path = layout.gold(version, table)
    if table in GOLD_PARTITIONS:
        write_slices(prepare_gold(df, table), path, MONTH_COLUMN, version)
    else:
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return path


def gold_log(spark: SparkSession, layout: Layout) -> VersionLog:
    return VersionLog(spark, layout.gold_root)


def publish_gold(
    spark: SparkSession,
    layout: Layout,
    version: str,
    months: dict[str, dict] | None = None,
    schema: dict | None = None,
    keys_hold: bool = False,
    cohort_months_read: list[str] | None = None,
) -> int:
    """Point readers at ``version`` (the single step that makes a refresh visible).

    ``months`` tells for each month of the fact which version wrote it, and its
    print; ``schema`` is the fact's; ``keys_hold`` whether keys and constraints
    were enforced. ``cohort_months_read`` are the months that the cohort mart was
    brought up to date from, if it was not built from all.
    """
    manifest = {"version": version, "months": months or {}, "schema": schema, "keys_hold": keys_hold}
    return gold_log(spark, layout).publish(manifest | {"cohort_months_read": cohort_months_read})


def current_gold_version(spark: SparkSession, layout: Layout) -> str:
    return gold_manifest(spark, layout)["version"]


def gold_manifest(spark: SparkSession, layout: Layout, version: str | None = None) -> dict:
    """The newest manifest, or the newest one of ``version``."""
    log = gold_log(spark, layout)
    for number in reversed(log.numbers()):
        manifest = log.read(number)
        if version in (None, manifest["version"]):
            return manifest
    raise FileNotFoundError(f"no published gold version {version or ''} under {layout.gold_root}")


def read_gold(
    spark: SparkSession,
    layout: Layout,
    table: str,
    version: str | None = None,
    schema: StructType | None = None,
    months: dict[str, str] | None = None,
) -> DataFrame:
    """A published (or given) version of a gold table. ``months`` are the fact's, of a version not published yet.

    A partitioned table also exposes its ``date_month`` partition column;
    filtering on it prunes whole month directories. With ``schema`` (the
    table's schema as built) nothing is inferred, so an empty partitioned
    table reads as empty.
    """
    if table in GOLD_PARTITIONS:
        if months is None:
            manifest = gold_manifest(spark, layout, version)
            months = {m: entry["version"] for m, entry in manifest["months"].items()}
            schema = schema or StructType.fromJson(manifest["schema"])
        return read_slices(spark, layout.gold(version, table), MONTH_COLUMN, DateType(), months, schema)
    version = version or current_gold_version(spark, layout)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(layout.gold(version, table))
