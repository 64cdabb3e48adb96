"""Business reports over the gold star schema and the rollups they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import MONEY_SUM, count_ratio, exceeds_ratio, pct_2dp, round2
from ledgerline.operators.skew import join_splitting_hot_keys
from ledgerline.schemas import RISKY_CATEGORIES

# --- Fixed values: report thresholds ------------------------------------------
MIN_CAPTURED_FOR_RATE = 20       # chargeback ranking needs more captures than this
CHARGEBACK_RANK_LIMIT = 20
HIGH_CHARGEBACK_RATE = "0.02"
MULTI_CHARGEBACK_MIN = 2
RISKY_VOLUME_SHARE = "0.30"
FRAUD_QUEUE_LIMIT = 50
# -------------------------------------------------------------------------------


def merchant_stats(fct: DataFrame, dim_merch: DataFrame) -> DataFrame:
    """Per merchant: payments, captured, chargebacks, USD volume.

    The fact is aggregated per ``merchant_id`` before it meets the merchant
    dimension (partial aggregation collapses a heavy merchant inside each
    task); the join then touches one row per merchant. The regroup on the
    dimension attributes reproduces join-then-aggregate exactly, and needs no
    new shuffle because the rows are already clustered by ``merchant_id``.
    """
    per_merchant = fct.groupBy("merchant_id").agg(
        F.count("*").alias("total_payments"),
        F.count_if(F.col("status") == "captured").alias("captured_payments"),
        F.count_if("has_chargeback").alias("chargebacks"),
        F.sum("amount_usd").alias("gross_volume_usd"),
    )
    return (
        per_merchant.join(dim_merch.select("merchant_id", "category", "risk_level"), "merchant_id")
        .groupBy("merchant_id", "category", "risk_level")
        .agg(
            F.sum("total_payments").alias("total_payments"),
            F.sum("captured_payments").alias("captured_payments"),
            F.sum("chargebacks").alias("chargebacks"),
            F.sum("gross_volume_usd").alias("gross_volume_usd"),
        )
    )


def _chargeback_rate():
    """Exact chargebacks / captured as a decimal (NULL without captures)."""
    return count_ratio(F.col("chargebacks"), F.col("captured_payments"))


def chargeback_rate_by_merchant(stats: DataFrame) -> DataFrame:
    """Top merchants by chargeback rate among those with enough captures.

    Ties on the unrounded rate are broken by ``merchant_id``.
    """
    return (
        stats.where(F.col("captured_payments") > MIN_CAPTURED_FOR_RATE)
        .orderBy(_chargeback_rate().desc_nulls_last(), F.col("merchant_id").asc())
        .limit(CHARGEBACK_RANK_LIMIT)
        .select(
            "merchant_id",
            "category",
            "risk_level",
            "total_payments",
            "captured_payments",
            "chargebacks",
            round2(F.col("gross_volume_usd")).alias("gross_volume_usd"),
            pct_2dp(F.col("chargebacks"), F.col("captured_payments")).alias("chargeback_rate_pct"),
        )
    )


def high_risk_merchants(stats: DataFrame) -> DataFrame:
    """Merchants tripping any of: declared high risk, risky category, rate > 2 %."""
    high = F.col("risk_level") == "high"
    risky_category = F.col("category").isin(*RISKY_CATEGORIES)
    over = exceeds_ratio(F.col("chargebacks"), F.col("captured_payments"), HIGH_CHARGEBACK_RATE)
    return (
        stats.where(high | risky_category | over)
        .select(
            "merchant_id",
            "category",
            "risk_level",
            "total_payments",
            "chargebacks",
            pct_2dp(F.col("chargebacks"), F.col("captured_payments")).alias("chargeback_rate_pct"),
            round2(F.col("gross_volume_usd")).alias("gross_volume_usd"),
            high.alias("flag_risk_high"),
            risky_category.alias("flag_category_risky"),
            over.alias("flag_chargeback_over_2pct"),
            _chargeback_rate().alias("_rate"),
        )
        .orderBy(F.col("_rate").desc_nulls_last(), F.col("gross_volume_usd").desc(), F.col("merchant_id").asc())
        .drop("_rate")
    )


def customer_risk_stats(fct: DataFrame, dim_merch: DataFrame) -> DataFrame:
    """Per customer: payments, chargebacks, USD volume, volume at risky merchants.

    Merchants join first: while they are small enough to be broadcast, the only
    shuffle of the fact is the one by customer, after partial sums (a heavy
    customer collapses inside each task). Grouping by (customer, merchant) first
    would shuffle nearly as many rows as there are payments, twice.
    """
    merchants = dim_merch.select("merchant_id", "category", "risk_level")
    risky = (F.col("risk_level") == "high") | F.col("category").isin(*RISKY_CATEGORIES)
    return (
        join_splitting_hot_keys(
            fct.select("customer_id", "merchant_id", "has_chargeback", "amount_usd"), merchants, "merchant_id"
        )
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_payments"),
            F.count_if("has_chargeback").alias("chargebacks"),
            F.sum("amount_usd").cast(MONEY_SUM).alias("total_volume_usd"),
            F.sum(F.when(risky, F.col("amount_usd")).otherwise(F.lit(0))).cast(MONEY_SUM).alias("risky_volume_usd"),
        )
    )


def fraud_signals(cust_stats: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Customers with any fraud signal, most signals and largest volume first.

    A NULL signal count (zero volume makes the risky share unknown) sorts first,
    as NULLs do in a descending sort on the reference's database.
    """
    total, risky = F.col("total_volume_usd"), F.col("risky_volume_usd")
    flagged = cust_stats.join(dim_cust, "customer_id").select(
        "customer_id",
        "country",
        "cohort_month",
        "total_payments",
        "chargebacks",
        round2(total).alias("total_volume_usd"),
        pct_2dp(risky, total, counts=False).alias("risky_volume_pct"),
        F.col("is_blacklisted").alias("signal_blacklist"),
        (F.col("chargebacks") >= MULTI_CHARGEBACK_MIN).alias("signal_multi_chargeback"),
        exceeds_ratio(risky, total, RISKY_VOLUME_SHARE).alias("signal_risky_merchants"),
    )
    blacklist, multi, risky_share = (
        F.col("signal_blacklist"),
        F.col("signal_multi_chargeback"),
        F.col("signal_risky_merchants"),
    )
    # NULL if any signal is NULL, like the boolean-to-int sum it mirrors.
    count = blacklist.cast("int") + multi.cast("int") + risky_share.cast("int")
    return (
        flagged.where(blacklist | multi | risky_share)
        .select("*", count.alias("signals_triggered"))
        .orderBy(
            F.col("signals_triggered").desc_nulls_first(),
            F.col("total_volume_usd").desc_nulls_first(),
            F.col("customer_id").asc(),
        )
        .limit(FRAUD_QUEUE_LIMIT)
    )


def auth_rate_daily(kpis: DataFrame) -> DataFrame:
    """Daily authorisation and chargeback rates in percent, by day."""
    return kpis.select(
        "date_key",
        "total_payments",
        "captured_payments",
        round2(F.col("auth_rate") * 100).alias("auth_rate_pct"),
        round2(F.col("chargeback_rate") * 100).alias("chargeback_rate_pct"),
        round2(F.col("gross_volume_usd")).alias("gross_volume_usd"),
        round2(F.col("captured_volume_usd")).alias("captured_volume_usd"),
        "unique_customers",
        "unique_merchants",
    ).orderBy(F.col("date_key").asc())


def cohort_size(dim_cust: DataFrame) -> DataFrame:
    """Customers per signup cohort, paying or not."""
    return dim_cust.groupBy("cohort_month").agg(F.count("*").alias("cohort_customers"))


def ltv_by_cohort(cohort_ltv: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cohort mart with cohort size and retention (active / cohort size, percent)."""
    return (
        cohort_ltv.join(sizes, "cohort_month")
        .select(
            "cohort_month",
            "cohort_customers",
            "months_since_signup",
            "active_customers",
            pct_2dp(F.col("active_customers"), F.col("cohort_customers")).alias("retention_pct"),
            round2(F.col("total_ltv_usd")).alias("total_ltv_usd"),
            round2(F.col("avg_ltv_usd")).alias("avg_ltv_usd"),
        )
        .orderBy(F.col("cohort_month").asc(), F.col("months_since_signup").asc())
    )
