"""Composite refresh jobs: bronze ingest, silver refresh, gold refresh.

Each job reads its input layer, composes the operators lazily, and writes its
output layer; the written layer is what the next job reads, so lineage is cut
at every layer boundary. Bronze row counts are collected with ``Observation``
inside the writing job, counts of rejected payments from the written footers.
Quality gates, on unless switched off, stop a run before it publishes.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict
from datetime import date
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import clean, enrich, events, gold, quality
from ledgerline.plans.catalog import Gold, gold_schemas
from ledgerline.sources import lake
from ledgerline.sources.event_index import EventIndex, IndexState, arrived_on, buckets_for, day_counts
from ledgerline.sources.lake import Layout, SilverTable
from ledgerline.sources.raw import RESCUED
from ledgerline.streaming.landing import read_landing_days

LOG = logging.getLogger(__name__)
T = TypeVar("T")

RAW_TABLES = ["customers", "merchants", "payments", "chargebacks", "fx_rates", "events", "blacklist"]
GOLD_TABLES = ["dim_customer", "dim_merchant", "dim_date", "fct_payments", "agg_daily_kpis", "agg_cohort_ltv"]

# Errors meaning "the stream landing does not exist yet"; anything else is raised.
_NO_LANDING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


# Independent writes of one layer are submitted as concurrent Spark jobs, so
# small tables do not leave the cluster idle while they run one after another.
WRITE_PARALLELISM = 8


def run_concurrently(tasks: dict[str, Callable[[], T]], parallelism: int = WRITE_PARALLELISM) -> dict[str, T]:
    """Run independent job functions from driver threads; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def bronze_ingest(spark: SparkSession, layout: Layout, ds: str, raw: Mapping[str, DataFrame]) -> dict[str, int]:
    """Land every raw dataset as bronze partition ``dt=<ds>``; return rows per table.

    Lines that did not fit the schema land too, their text beside what could be
    read of them, if the reader kept it (``lake.read_rescued``).
    """

    def ingest(table: str) -> Callable[[], int]:
        def run() -> int:
            obs = Observation(f"bronze_{table}")
            misfit = F.col(RESCUED).isNotNull() if RESCUED in raw[table].columns else F.lit(False)
            counts = (F.count(F.lit(1)).alias("rows"), F.count_if(misfit).alias("rescued"))
            lake.write_bronze(raw[table].observe(obs, *counts), layout, table, ds)
            rows, rescued = obs.get["rows"], obs.get["rescued"]
            LOG.info("bronze %s dt=%s: %d rows", table, ds, rows)
            if rescued:
                LOG.warning("bronze %s dt=%s: %d lines do not fit the schema", table, ds, rescued)
            return rows

        return run

    return run_concurrently({t: ingest(t) for t in RAW_TABLES})


def read_stream_landing(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The stream landing with its arrival days, or ``None`` if the streaming job never ran."""
    try:
        return read_landing_days(spark, layout.stream_landing)
    except AnalysisException as exc:
        if (exc.getCondition() or "") in _NO_LANDING:
            LOG.info("no stream landing (%s); using batch events only", exc.getCondition())
            return None
        raise


def silver_refresh(spark: SparkSession, layout: Layout, ds: str, gate: bool = False) -> dict[str, int]:
    """Bronze of ``ds`` -> a new silver version; returns the payment drop counts.

    Every table is written into folders of this run; one manifest then
    publishes them together, so a run that fails, or whose payments do not pass
    their suite (``gate``), leaves the silver before it as it was.

    With a stream landing, events are reconciled incrementally: only arrival days
    that changed since the published version are read. Events delivered by
    earlier runs stay, also if the batch of ``ds`` no longer holds them.

    Payments that a rule rejects are kept as ``payments_rejected``, with the rule.
    The counts come from the written files, so a task that ran twice counts once,
    and a run whose files hold fewer payments than were read is not published.

    A day and currency quoted twice would price its payments twice, so it fails
    the run (:class:`~ledgerline.operators.quality.ConstraintsViolated`) before
    anything is written.
    """
    run = lake.new_run()
    with lake.silver_log(spark, layout).holding(run) as before:
        return _silver_refresh(spark, layout, ds, gate, run, lake.silver_tables(before))


def _silver_refresh(
    spark: SparkSession, layout: Layout, ds: str, gate: bool, run: str, before: dict[str, SilverTable]
) -> dict[str, int]:
    b = {t: lake.read_bronze(spark, layout, t, ds) for t in RAW_TABLES}
    customers = clean.clean_customers(b["customers"])
    merchants = clean.clean_merchants(b["merchants"])
    payments = clean.clean_payments(b["payments"])
    chargebacks = clean.clean_chargebacks(b["chargebacks"])
    fx_rates = clean.clean_fx_rates(b["fx_rates"])
    denylist = clean.distinct_denylist(b["blacklist"])
    quality.require_unique(fx_rates.where(F.col("to_ccy") == "USD"), ["date", "from_ccy"], "fx_rates to USD")

    outputs = {
        "customers": enrich.enrich_customers(customers, denylist),
        "merchants": merchants,
        "chargebacks": chargebacks,
        "fx_rates": fx_rates,
        "blacklist": denylist,
    }
    tasks: dict[str, Callable[[], dict[str, SilverTable]]] = {}
    stream = read_stream_landing(spark, layout)
    if stream is None:
        outputs["events"] = clean.clean_events(b["events"])
    else:
        tasks["events"] = lambda: _reconcile_events(spark, layout, run, b["events"], stream, before)

    by_outcome = enrich.payments_by_outcome(payments, customers, merchants, fx_rates, chargebacks)
    tasks["payments"] = lambda: lake.write_outcomes(by_outcome, layout, run)

    for table, df in outputs.items():
        tasks[table] = lambda t=table, df=df: {t: lake.write_silver(df, layout, run, t)}
    written = {name: entry for part in run_concurrently(tasks).values() for name, entry in part.items()}
    if gate:
        quality.validate(lake.read_silver_table(spark, layout, "payments", written["payments"]), "silver_payments")
    counts = lake.outcome_counts(spark, layout, written)
    _require_all_accounted(payments.count(), counts)
    lake.publish_silver(spark, layout, run, ds, written)
    drops = {rule: counts[rule] for rule in enrich.DROP_RULES}
    for rule, n in drops.items():
        if n:
            LOG.warning("silver rejected %d payments: %s", n, rule)
    return drops


class PaymentsLost(RuntimeError):
    """Fewer payments were written, kept and rejected together, than bronze holds."""


def _require_all_accounted(read: int, written: Mapping[str, int]) -> None:
    """Kept and rejected payments are those that were read; keys that occur twice make more of them, never fewer."""
    total = sum(written.values())
    if total < read:
        raise PaymentsLost(f"{read} payments read, {total} written: {dict(written)}")
    if total > read:
        LOG.warning("silver: %d payments became %d rows: customers, merchants or chargebacks repeat keys", read, total)


def _reconcile_events(
    spark: SparkSession, layout: Layout, run: str, batch: DataFrame, landing: DataFrame, before: dict[str, SilverTable]
) -> dict[str, SilverTable]:
    """Bring the event index up to date; rows without an id go to the quarantine of their arrival day."""
    known = before.get("events")
    days = day_counts(landing)
    state = IndexState(**known.index) if known and known.index else IndexState(buckets=buckets_for(sum(days.values())))
    state, read = EventIndex(spark, layout.event_index, state.buckets).reconcile(batch, landing, state, days=days)
    LOG.info("events: arrival days read: %s", ", ".join(read) or "none")
    lost = events.quarantine(batch, landing.where(arrived_on(read)))
    return {
        "events": SilverTable(clean.clean_events(batch).schema.jsonValue(), index=asdict(state)),
        "events_quarantine": lake.write_quarantine(
            lost, layout, run, [d or lake.NULL_SLICE for d in read], before.get("events_quarantine")
        ),
    }


def gold_refresh(spark: SparkSession, layout: Layout, gate: bool = True) -> str:
    """Silver -> a new gold version, published only when every table is written.

    The fact's months are compared with those of the published version by their
    prints; months that did not change are referred to, only the others are
    read, sorted and written. Both marts and the calendar are built from the written fact, so they agree
    with what was published and nothing is held in executor memory; the cohort
    mart takes the cells of unchanged months from the version before. Unless
    ``gate`` is switched off, the fact's suite and every key and constraint of
    the written tables must hold, else the version is not published.
    """
    version = lake.new_run()
    silver_held = lake.silver_log(spark, layout).holding()
    with silver_held as silver, lake.gold_log(spark, layout).holding(version) as before:
        return _gold_refresh(spark, layout, gate, version, lake.silver_tables(silver), before)


def _gold_refresh(
    spark: SparkSession, layout: Layout, gate: bool, version: str, tables: dict[str, SilverTable], before: dict | None
) -> str:
    silver = {t: lake.read_silver_table(spark, layout, t, tables[t]) for t in ("customers", "merchants", "payments")}
    new_fct = gold.fct_payments(silver["payments"])
    months: dict[str, dict] = {}

    def write(table: str, df: DataFrame) -> Callable[[], str]:
        return lambda: lake.write_gold(df, layout, version, table)

    def write_changed_months() -> None:
        if before is None or before["schema"] != new_fct.schema.jsonValue():  # nothing to compare with: prints come later
            lake.write_gold(new_fct, layout, version, "fct_payments")
            root = layout.gold(version, "fct_payments")
            months.update({m: {"version": version} for m in lake.written_slices(spark, root, lake.MONTH_COLUMN, version)})
            return
        months.update(_compared_months(new_fct, before["months"]))
        changed = [m for m, entry in months.items() if "version" not in entry]
        if changed:
            in_changed = F.trunc("date_key", "MM").isin([date.fromisoformat(m) for m in changed])
            lake.write_gold(new_fct.where(in_changed), layout, version, "fct_payments")
        for m in changed:
            months[m]["version"] = version
        LOG.info("gold fact: %d of %d months written", len(changed), len(months))

    run_concurrently(
        {
            "dim_customer": write("dim_customer", gold.dim_customer(silver["customers"])),
            "dim_merchant": write("dim_merchant", gold.dim_merchant(silver["merchants"])),
            "fct_payments": write_changed_months,
        }
    )
    where = {m: entry["version"] for m, entry in months.items()}
    fct = lake.read_gold(spark, layout, "fct_payments", version, new_fct.schema, where)
    dim_customer = lake.read_gold(
        spark, layout, "dim_customer", version, schema=gold.dim_customer(silver["customers"]).schema
    )
    cohort_months = _cohort_months_to_read(spark, layout, version, before, months, dim_customer)

    def cohort_mart() -> DataFrame:
        if cohort_months is None:
            return gold.agg_cohort_ltv(dim_customer, fct)
        changed = fct.where(F.col(lake.MONTH_COLUMN).isin([date.fromisoformat(m) for m in cohort_months]))
        cells = gold.agg_cohort_ltv(dim_customer, changed)
        mart = lake.read_gold(spark, layout, "agg_cohort_ltv", before["version"], cells.schema)
        return gold.merge_cohort_ltv(mart, cells, [date.fromisoformat(m) for m in set(months) - set(cohort_months)])

    tasks = {
        "dim_date": write("dim_date", gold.dim_date(fct)),
        "agg_daily_kpis": write("agg_daily_kpis", gold.agg_daily_kpis(fct)),
        "agg_cohort_ltv": write("agg_cohort_ltv", cohort_mart()),
    }
    if gate:
        tasks["gate"] = lambda: quality.validate(fct, "gold_fct_payments")
    if any("print" not in entry for entry in months.values()):
        tasks["prints"] = lambda: lake.month_prints(fct)
    done = run_concurrently(tasks)
    for m, entry in done.get("prints", {}).items():
        months[m] |= entry
    if gate:
        unique = quality.keys_checked("gold_fct_payments", "fct_payments")
        quality.enforce_constraints(_gold_version(spark, layout, version, fct).tables, unique)
    lake.publish_gold(spark, layout, version, months, new_fct.schema.jsonValue(), gate, cohort_months)
    return version


def _cohort_months_to_read(
    spark: SparkSession, layout: Layout, version: str, before: dict | None, months: dict[str, dict], customers: DataFrame
) -> list[str] | None:
    """The fact's months whose cohort cells must be built anew; ``None`` if all must.

    Cells are taken over from a version whose keys were enforced (a month that
    did not change then holds payments of customers known to that version only),
    as long as those customers kept their cohorts.
    """
    changed = sorted(m for m, entry in months.items() if entry["version"] == version)
    if before is None or not before.get("keys_hold") or len(changed) == len(months):
        return None
    if not all(m[:1].isdigit() for m in months):  # payments without a day are in no month
        return None
    schemas = gold_schemas(spark)
    mart = lake.read_gold(spark, layout, "agg_cohort_ltv", before["version"], schemas["agg_cohort_ltv"])
    if not mart.where("cohort_month is null or months_since_signup is null").isEmpty():
        return None
    known = lake.read_gold(spark, layout, "dim_customer", before["version"], schemas["dim_customer"])
    return changed if gold.cohorts_kept(known, customers) else None


def _compared_months(fct: DataFrame, before: dict[str, dict]) -> dict[str, dict]:
    """The prints of all months; those that a version before holds alike name the version that wrote them."""
    prints = lake.month_prints(fct)
    for month, entry in before.items():
        if month in prints and all(entry.get(k) == prints[month][k] for k in ("rows", "print")):
            prints[month]["version"] = entry["version"]
    return prints


def _gold_version(spark: SparkSession, layout: Layout, version: str, fct: DataFrame) -> Gold:
    schemas = gold_schemas(spark)
    others = (t for t in GOLD_TABLES if t not in lake.GOLD_PARTITIONS)
    return Gold({t: lake.read_gold(spark, layout, t, version, schemas[t]) for t in others} | {"fct_payments": fct})


def published_gold(spark: SparkSession, layout: Layout, manifest: dict | None = None) -> Gold:
    """The newest gold version, or that of a manifest held by ``VersionLog.holding``.

    Its months are those of one manifest, whatever is published meanwhile.
    """
    manifest = manifest or lake.gold_manifest(spark, layout)
    months = {m: entry["version"] for m, entry in manifest["months"].items()}
    schema = gold_schemas(spark)["fct_payments"]
    fct = lake.read_gold(spark, layout, "fct_payments", manifest["version"], schema, months)
    return _gold_version(spark, layout, manifest["version"], fct)


def full_refresh(
    spark: SparkSession,
    layout: Layout,
    ds: str,
    raw: Mapping[str, DataFrame],
    gates: tuple[str, ...] = tuple(quality.SUITES),
) -> dict:
    """Bronze -> silver -> gold for one run date, behind the quality gates.

    ``gates`` names the suites that must pass: all of them, unless the caller
    names fewer. A failing gate raises
    :class:`~ledgerline.operators.quality.SuiteFailed` before the next layer;
    ``gold_fct_payments`` also enforces the keys and constraints of all gold tables.
    """
    out: dict = {"bronze": bronze_ingest(spark, layout, ds, raw)}
    if "bronze_payments" in gates:
        quality.validate(lake.read_bronze(spark, layout, "payments", ds), "bronze_payments")
    out["silver_drops"] = silver_refresh(spark, layout, ds, gate="silver_payments" in gates)
    out["gold_version"] = gold_refresh(spark, layout, gate="gold_fct_payments" in gates)
    return out
