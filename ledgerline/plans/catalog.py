"""Lazily composed lake layers and the registry of named queries.

A :class:`Lake` holds the raw datasets of one run and derives every silver and
gold table from them on first use, as one lazy DataFrame plan per table; the
same builders serve the refresh jobs (which write each layer) and the ad-hoc
queries (which let Catalyst optimise raw -> report in one plan).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import clean, enrich, events, gold, reports
from ledgerline.session import materialize
from ledgerline.sources import testdata


class LazyTables(Mapping):
    """A read-only name -> DataFrame mapping that builds each table on first access."""

    def __init__(self, names: list[str], build: Callable[[str], DataFrame]):
        self._names = list(names)
        self._build = build
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Lake:
    """Silver and gold tables derived from the raw datasets ``raw``.

    ``raw`` maps bronze table names (``customers merchants payments chargebacks
    fx_rates events blacklist``) to raw-schema DataFrames; ``stream`` is the
    stream landing of events, or ``None`` when the stream has never run.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        stream: DataFrame | None = None,
        stream_builder: Callable[[], DataFrame] | None = None,
    ):
        self.raw = raw
        self._stream = stream
        self._stream_builder = stream_builder

    @property
    def stream(self) -> DataFrame | None:
        if self._stream is None and self._stream_builder is not None:
            self._stream = self._stream_builder()
        return self._stream

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        from ledgerline.streaming.landing import parse_messages

        return cls(
            LazyTables(testdata.RAW_TABLES, lambda t: testdata.raw_table(spark, sf_dir, t)),
            stream_builder=lambda: parse_messages(testdata.event_messages(spark, sf_dir)),
        )

    # ---- silver ------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw["customers"])

    @cached_property
    def merchants(self) -> DataFrame:
        return clean.clean_merchants(self.raw["merchants"])

    @cached_property
    def payments(self) -> DataFrame:
        return clean.clean_payments(self.raw["payments"])

    @cached_property
    def chargebacks(self) -> DataFrame:
        return clean.clean_chargebacks(self.raw["chargebacks"])

    @cached_property
    def fx_rates(self) -> DataFrame:
        return clean.clean_fx_rates(self.raw["fx_rates"])

    @cached_property
    def denylist(self) -> DataFrame:
        return clean.distinct_denylist(self.raw["blacklist"])

    @cached_property
    def events_batch_only(self) -> DataFrame:
        """Batch events alone: the fallback when no stream landing exists (not deduplicated)."""
        return clean.clean_events(self.raw["events"])

    @cached_property
    def events(self) -> DataFrame:
        if self.stream is None:
            return self.events_batch_only
        return clean.clean_events(events.union_dedupe(self.raw["events"], self.stream))

    @cached_property
    def silver_customers(self) -> DataFrame:
        return enrich.enrich_customers(self.customers, self.denylist)

    @cached_property
    def silver_payments(self) -> DataFrame:
        return enrich.enrich_payments(
            self.payments, self.customers, self.merchants, self.fx_rates, self.chargebacks
        )

    # ---- gold --------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver_customers)

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return gold.dim_merchant(self.merchants)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return gold.fct_payments(self.silver_payments)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.fct_payments)

    @cached_property
    def agg_daily_kpis(self) -> DataFrame:
        return gold.agg_daily_kpis(self.fct_payments)

    @cached_property
    def agg_cohort_ltv(self) -> DataFrame:
        return gold.agg_cohort_ltv(self.dim_customer, self.fct_payments)


GOLD_TABLES = ["dim_customer", "dim_merchant", "dim_date", "fct_payments", "agg_daily_kpis", "agg_cohort_ltv"]


class Gold:
    """The gold tables a report needs; built from a :class:`Lake` or read from disk."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    @classmethod
    def of(cls, lake: Lake) -> "Gold":
        return cls(LazyTables(GOLD_TABLES, lambda n: getattr(lake, n)))

    @classmethod
    def materialized(cls, lake: Lake) -> "Gold":
        """Gold whose fact and customer dimension are written once and read back.

        For multi-branch jobs over the whole star schema (the constraint
        report): every branch reads the written tables instead of recomputing
        the silver joins from raw data.
        """
        fct = materialize(lake.fct_payments, "fct_payments")
        dim_cust = materialize(lake.dim_customer, "dim_customer")
        return cls(
            {
                "dim_customer": dim_cust,
                "dim_merchant": lake.dim_merchant,
                "dim_date": gold.dim_date(fct),
                "fct_payments": fct,
                "agg_daily_kpis": gold.agg_daily_kpis(fct),
                "agg_cohort_ltv": gold.agg_cohort_ltv(dim_cust, fct),
            }
        )

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def merchant_stats(self) -> DataFrame:
        return reports.merchant_stats(self["fct_payments"], self["dim_merchant"])

    def customer_risk_stats(self) -> DataFrame:
        return reports.customer_risk_stats(self["fct_payments"], self["dim_merchant"])

    def cohort_size(self) -> DataFrame:
        return reports.cohort_size(self["dim_customer"])

    def auth_rate_daily(self) -> DataFrame:
        return reports.auth_rate_daily(self["agg_daily_kpis"])

    def chargeback_rate_by_merchant(self) -> DataFrame:
        return reports.chargeback_rate_by_merchant(self.merchant_stats())

    def high_risk_merchants(self) -> DataFrame:
        return reports.high_risk_merchants(self.merchant_stats())

    def fraud_signals(self) -> DataFrame:
        return reports.fraud_signals(self.customer_risk_stats(), self["dim_customer"])

    def ltv_by_cohort(self) -> DataFrame:
        return reports.ltv_by_cohort(self["agg_cohort_ltv"], self.cohort_size())


_GOLD_SCHEMAS: dict[tuple[str, int], dict] = {}


def gold_schemas(spark: SparkSession) -> dict[str, "StructType"]:
    """Schemas of the gold tables, derived by planning the operators over empty
    raw tables (analysis only, no job runs); computed once per session."""
    from ledgerline.schemas import RAW_SCHEMAS

    key = (spark.sparkContext.applicationId, id(spark))
    if key not in _GOLD_SCHEMAS:
        empty = {t: spark.createDataFrame([], schema) for t, schema in RAW_SCHEMAS.items()}
        lake = Lake(empty)
        _GOLD_SCHEMAS[key] = {t: getattr(lake, t).schema for t in GOLD_TABLES}
    return _GOLD_SCHEMAS[key]


REPORTS = ["auth_rate_daily", "chargeback_rate_by_merchant", "high_risk_merchants", "fraud_signals", "ltv_by_cohort"]


# ---- Named queries over the test tables -------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake.from_testdata(spark, sf_dir)


def _lake_query(build: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_lake(spark, sf_dir))


def _gold_query(build: Callable[[Gold], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Gold.of(_lake(spark, sf_dir)))


def _fk_payments(lake: Lake) -> DataFrame:
    return enrich.join_keys(lake.payments, lake.customers, lake.merchants)


def _filter_pre_signup(lake: Lake) -> DataFrame:
    return enrich.drop_pre_signup(_fk_payments(lake))


def _price_usd(lake: Lake) -> DataFrame:
    return enrich.price_usd(_filter_pre_signup(lake), lake.fx_rates)


def _drop_report(lake: Lake) -> DataFrame:
    return enrich.drop_report(lake.payments, lake.customers, lake.merchants, lake.fx_rates)


def _stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.streaming.landing import parse_messages

    return parse_messages(testdata.event_messages(spark, sf_dir))


def _quality(suite: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ledgerline.operators import quality

        lake = _lake(spark, sf_dir)
        table = {
            "bronze_payments": lambda: lake.raw["payments"],
            "silver_payments": lambda: lake.silver_payments,
            "gold_fct_payments": lambda: lake.fct_payments,
        }[suite]()
        return quality.suite_report(table, suite)

    return run


def _constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.operators import quality

    return quality.constraint_report(Gold.materialized(_lake(spark, sf_dir)).tables)


def _denylist_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.explode_denylist(testdata.denylist_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # silver
    "denylist_explode": _denylist_explode,
    "denylist_distinct": _lake_query(lambda k: k.denylist),
    "clean_customers": _lake_query(lambda k: k.customers),
    "clean_merchants": _lake_query(lambda k: k.merchants),
    "clean_payments": _lake_query(lambda k: k.payments),
    "clean_chargebacks": _lake_query(lambda k: k.chargebacks),
    "clean_events": _lake_query(lambda k: k.events_batch_only),
    "fk_payments": _lake_query(_fk_payments),
    "filter_pre_signup": _lake_query(_filter_pre_signup),
    "price_usd": _lake_query(_price_usd),
    "enrich_customers": _lake_query(lambda k: k.silver_customers),
    "enrich_payments": _lake_query(lambda k: k.silver_payments),
    "drop_report": _lake_query(_drop_report),
    "events_union_dedupe": _lake_query(lambda k: k.events),
    "stream_parse": _stream_parse,
    # gold
    "dim_customer": _lake_query(lambda k: k.dim_customer),
    "dim_merchant": _lake_query(lambda k: k.dim_merchant),
    "dim_date": _lake_query(lambda k: k.dim_date),
    "fct_payments": _lake_query(lambda k: k.fct_payments),
    "agg_daily_kpis": _lake_query(lambda k: k.agg_daily_kpis),
    "agg_cohort_ltv": _lake_query(lambda k: k.agg_cohort_ltv),
    "merchant_stats": _gold_query(lambda g: g.merchant_stats()),
    "customer_risk_stats": _gold_query(lambda g: g.customer_risk_stats()),
    "cohort_size": _gold_query(lambda g: g.cohort_size()),
    # reports
    "auth_rate_daily": _gold_query(lambda g: g.auth_rate_daily()),
    "chargeback_rate_by_merchant": _gold_query(lambda g: g.chargeback_rate_by_merchant()),
    "high_risk_merchants": _gold_query(lambda g: g.high_risk_merchants()),
    "fraud_signals": _gold_query(lambda g: g.fraud_signals()),
    "ltv_by_cohort": _gold_query(lambda g: g.ltv_by_cohort()),
    # quality
    "dq_bronze_payments": _quality("bronze_payments"),
    "dq_silver_payments": _quality("silver_payments"),
    "dq_gold_fct_payments": _quality("gold_fct_payments"),
    "constraint_report": _constraint_report,
}

