"""Raw payments-domain tables derived from the TPC-H-style test tables.

The given parquet tables (``lineitem orders customer supplier events``) are
mapped, with integer arithmetic only, to the seven raw datasets the lake ingests
(payments, customers, merchants, chargebacks, FX rates, events, denylist). The
rules are those of ``FIXTURES.md`` section C; every output is a lazy DataFrame
with the raw string-typed schema of :mod:`ledgerline.schemas`, so the rest of
the lake cannot tell it from landed files. No row of a given table is left out;
only chargebacks and the denylist are subsets, which is what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import materialize

# --- Fixed values of the test-data mapping ----------------------------------
# (upper bound of the bucket, value); a value applies when bucket < bound.
CURRENCY_BY_MOD20 = [(1, "CLP"), (3, "EUR"), (5, "MXN"), (8, "BRL"), (14, "ARS"), (20, "USD")]
STATUS_BY_MOD100 = [(82, "captured"), (94, "refused"), (98, "refunded"), (100, "pending")]
METHOD_BY_MOD20 = [(11, "card"), (16, "wallet"), (19, "bank_transfer"), (20, "crypto")]
COUNTRY_BY_MOD6 = ["AR", "US", "BR", "MX", "CL", "ES"]
CATEGORY_BY_MOD7 = ["retail", "groceries", "crypto", "gaming", "travel", "saas", "digital_content"]
RISK_BY_MOD3 = ["low", "medium", "high"]
REASON_BY_MOD4 = ["FRAUD", "DISPUTED", "NOT_RECEIVED", "DUPLICATE"]
EVENT_TYPE = {
    "click": "login",
    "view": "login",
    "error": "failed_pin",
    "purchase": "password_reset",
    "signup": "kyc_submit",
}
# FX: (index, currency, base micro-rate); days 1995-01-01 .. 2001-12-31.
FX_BASES = [(0, "USD", 1000000), (1, "ARS", 1200), (2, "BRL", 200000), (3, "MXN", 58000), (4, "EUR", 1080000)]
FX_FIRST_DAY = "1995-01-01"
FX_LAST_DAY = "2001-12-31"
EPOCH = "1995-01-01"
DENYLIST_UPDATED_AT = "2001-12-31T23:59:59+00:00"
# -----------------------------------------------------------------------------

# The gates this mapping passes: it holds a currency and amounts that the bronze suite refuses.
PASSING_GATES = ("silver_payments", "gold_fct_payments")

# Ids per denylist document: documents are built per key range so that no
# single group holds every denylisted id.
DENYLIST_DOC_SPAN = 4096

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


_READS: dict[tuple[str, int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given test table. The test tables are read-only, so one read per
    session and path is reused (saves the file listing on every query)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _bucket(value: Column, bounds: list[tuple[int, str]]) -> Column:
    expr = None
    for bound, label in bounds:
        expr = F.when(value < bound, label) if expr is None else expr.when(value < bound, label)
    return expr


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _iso_utc(ts: Column, pattern: str = ISO_SECONDS) -> Column:
    """A zone-less timestamp written as ISO-8601 with a ``+00:00`` offset."""
    return F.concat(F.date_format(ts, pattern), F.lit("+00:00"))


def _days_after_epoch(n: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), n.cast("int"))


def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with their mapping keys ``ok``, ``ln``, ``sk`` still attached.

    Built once per session and folder (payments and chargebacks share it).

    One payment per (order key, line number) of ``lineitem``. The per-line
    aggregate runs map-side first, so an order key holding a large share of the
    lines collapses to at most one row per line number inside each task before
    anything is shuffled.
    """
    key = (spark.sparkContext.applicationId, id(spark), f"payment_lines:{sf_dir}")
    if key not in _READS:
        _READS[key] = _payment_lines(spark, sf_dir)
    return _READS[key]


def _payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("ok"),
            F.col("l_linenumber").alias("ln"),
            "l_suppkey",
            "l_extendedprice",
        )
        .groupBy("ok", "ln")
        .agg(
            F.min("l_suppkey").alias("sk"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("amt"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ok"), "o_custkey", "o_orderdate"
    )
    ok, ln = F.col("ok"), F.col("ln")
    created = F.col("o_orderdate") + F.make_dt_interval(hours=ln)
    updated = created + F.make_dt_interval(mins=(ok * 7 + ln) % 720)
    return lines.join(orders, "ok").select(
        "ok",
        "ln",
        "sk",
        F.concat(F.lit("p_"), ok, F.lit("_"), ln).alias("payment_id"),
        # Orphans: some payments name a customer or merchant that is in no table.
        F.concat(F.when(F.col("o_custkey") % 97 == 3, "cx_").otherwise("c_"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.when(F.col("sk") % 41 == 9, "mx_").otherwise("m_"), F.col("sk")).alias("merchant_id"),
        F.col("amt").cast("double").alias("amount"),
        _bucket((ok + ln) % 20, CURRENCY_BY_MOD20).alias("currency"),
        _bucket((ok * 31 + ln * 17) % 100, STATUS_BY_MOD100).alias("status"),
        _iso_utc(created).alias("created_at"),
        _iso_utc(updated).alias("updated_at"),
        _bucket((ok + ln * 3) % 20, METHOD_BY_MOD20).alias("method"),
        created.alias("_created"),
    )


PAYMENT_COLUMNS = [
    "payment_id",
    "customer_id",
    "merchant_id",
    "amount",
    "currency",
    "status",
    "created_at",
    "updated_at",
    "method",
]


def written_payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`payment_lines`, written once: for jobs that ingest payments several times.

    Each ingest then reads the files instead of aggregating all lines and
    joining the orders again. Rows of an order lie together, which packs well.
    """
    return materialize(payment_lines(spark, sf_dir).sortWithinPartitions("ok"), "payment-lines")


def raw_payments(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Payments, of ``lines`` if they have been written already."""
    return (lines or payment_lines(spark, sf_dir)).select(*PAYMENT_COLUMNS)


def raw_chargebacks(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    ok, ln = F.col("ok"), F.col("ln")
    return (
        (lines or payment_lines(spark, sf_dir))
        .where(
            ((ok * 13 + ln) % 25 == 0)
            & (F.col("sk") % 4 != 0)
            & F.col("status").isin("captured", "refunded")
        )
        .select(
            "payment_id",
            _pick(ok % 4, REASON_BY_MOD4).alias("reason_code"),
            _iso_utc(F.col("_created") + F.make_dt_interval(days=5 + ok % 26)).alias("filed_at"),
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c_"), key).alias("customer_id"),
        _days_after_epoch((key * 37) % 900).cast("string").alias("signup_date"),
        _pick(F.col("c_nationkey") % 6, COUNTRY_BY_MOD6).alias("country"),
        F.col("c_mktsegment").alias("marketing_channel"),
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    created = _days_after_epoch((key * 11) % 900).cast("timestamp_ntz")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("m_"), key).alias("merchant_id"),
        _pick(key % 7, CATEGORY_BY_MOD7).alias("category"),
        _pick(key % 3, RISK_BY_MOD3).alias("risk_level"),
        _iso_utc(created).alias("created_at"),
    )


def raw_fx_rates(spark: SparkSession) -> DataFrame:
    """Daily quotes to USD for five currencies, generated from a rule.

    A reference table of fixed size (days x currencies), independent of the
    scale of the payment data.
    """
    first = F.lit(FX_FIRST_DAY).cast("date")
    n_days = spark.range(1).select(
        F.datediff(F.lit(FX_LAST_DAY).cast("date"), first).alias("n")
    )
    quotes = F.array(
        *[
            F.struct(F.lit(i).alias("idx"), F.lit(c).alias("ccy"), F.lit(b).cast("long").alias("base"))
            for i, c, b in FX_BASES
        ]
    )
    days = n_days.select(F.explode(F.sequence(F.lit(0), F.col("n"))).alias("d"))
    q = days.select("d", F.explode(quotes).alias("q"))
    micro = F.expr("q.base * (950 + (d * 7 + q.idx * 13) % 101) div 1000")
    return q.select(
        F.date_add(first, F.col("d")).cast("string").alias("date"),
        F.col("q.ccy").alias("from_ccy"),
        F.lit("USD").alias("to_ccy"),
        (micro / 1_000_000).cast("double").alias("rate"),
    )


def denylist_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denylist as documents ``(blacklisted_customer_ids, updated_at)``.

    The service publishes one document; here ids are grouped into one document
    per customer-key range, which explodes to exactly the same rows while
    keeping every group bounded.
    """
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .where(key % 50 == 7)
        .groupBy(F.floor(key / DENYLIST_DOC_SPAN).alias("doc"))
        .agg(F.sort_array(F.collect_list(F.concat(F.lit("c_"), key))).alias("blacklisted_customer_ids"))
        .select("blacklisted_customer_ids", F.lit(DENYLIST_UPDATED_AT).alias("updated_at"))
    )


def _mapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    etype = F.col("event_type")
    type_expr = None
    for src, dst in EVENT_TYPE.items():
        type_expr = F.when(etype == src, dst) if type_expr is None else type_expr.when(etype == src, dst)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"),
        F.col("ts").alias("_ts"),
        F.concat(F.lit("e_"), F.col("event_id")).alias("event_id"),
        F.concat(F.lit("c_"), F.col("user_id")).alias("customer_id"),
        type_expr.alias("type"),
        _iso_utc(F.col("ts"), ISO_MICROS).alias("event_ts"),
    )


EVENT_COLUMNS = ["event_id", "customer_id", "type", "event_ts"]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, as the daily batch file delivers it."""
    return _mapped_events(spark, sf_dir).select(*EVENT_COLUMNS)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, as the topic delivers it: ``(value, timestamp)`` messages.

    ``value`` is the event as a JSON object, ``timestamp`` the arrival time
    (two seconds after the event). Four fifths repeat the batch's id; the rest
    carry an id of the topic alone, so that both kinds reach the reconciliation.
    """
    own = F.concat(F.lit("es_"), F.col("_id"))
    return (
        _mapped_events(spark, sf_dir)
        .withColumn("event_id", F.when(F.col("_id") % 5 == 0, own).otherwise(F.col("event_id")))
        .select(
            F.to_json(F.struct(*EVENT_COLUMNS)).alias("value"),
            (F.col("_ts") + F.make_dt_interval(secs=F.lit(2))).cast("timestamp").alias("timestamp"),
        )
    )


RAW_TABLES = ["customers", "merchants", "payments", "chargebacks", "fx_rates", "events", "blacklist"]


def raw_table(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """One raw dataset of a run, named like its bronze table. ``lines``: see :func:`written_payment_lines`."""
    from ledgerline.operators.clean import explode_denylist

    builders = {
        "customers": lambda: raw_customers(spark, sf_dir),
        "merchants": lambda: raw_merchants(spark, sf_dir),
        "payments": lambda: raw_payments(spark, sf_dir, lines),
        "chargebacks": lambda: raw_chargebacks(spark, sf_dir, lines),
        "fx_rates": lambda: raw_fx_rates(spark),
        "events": lambda: raw_events(spark, sf_dir),
        "blacklist": lambda: explode_denylist(denylist_documents(spark, sf_dir)),
    }
    return builders[name]()


def raw_tables(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """All raw datasets of one run, keyed like the bronze tables."""
    return {name: raw_table(spark, sf_dir, name, lines) for name in RAW_TABLES}


def written_raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """:func:`raw_tables` for jobs that ingest them several times: what is derived from the lines is written once."""
    tables = raw_tables(spark, sf_dir, written_payment_lines(spark, sf_dir))
    return tables | {"chargebacks": materialize(tables["chargebacks"], "chargebacks")}
