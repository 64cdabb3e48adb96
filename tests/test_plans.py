"""Physical-plan properties that matter at scale, read from ``explain()``."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.plans import refresh
from ledgerline.plans.catalog import Gold, Lake
from ledgerline.sources import lake, testdata
from ledgerline.sources.lake import Layout
from tests.conftest import SF_SMALL

SQL_KEYS = sorted(entry.oracle_sql())


def plan_of(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", SQL_KEYS)
def test_no_cartesian_no_nested_loop_no_python(spark, key):
    plan = plan_of(entry.queries()[key](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


def test_fx_join_is_broadcast_after_size_check(spark):
    plan = plan_of(Lake.from_testdata(spark, SF_SMALL).silver_payments)
    assert "BroadcastHashJoin" in plan and "_fx_date" in plan


def test_lineitem_scan_is_pruned_and_filter_pushed(spark):
    plan = plan_of(Lake.from_testdata(spark, SF_SMALL).payments)
    scan = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in plan][0]
    assert "l_extendedprice" in scan and "l_comment" not in scan and "l_shipdate" not in scan


def test_gold_fact_is_month_partitioned_and_pruned(spark, tmp_root):
    layout = Layout(tmp_root)
    refresh.bronze_ingest(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL))
    refresh.silver_refresh(spark, layout, "d1")
    refresh.gold_refresh(spark, layout)
    fct = lake.read_gold(spark, layout, "fct_payments")
    day = fct.where((F.col("date_month") == F.lit("1997-03-01").cast("date")) & (F.col("date_key") == F.lit("1997-03-05").cast("date")))
    plan = plan_of(day)
    assert "PartitionFilters: [isnotnull(date_month" in plan
    assert "PushedFilters: [IsNotNull(date_key), EqualTo(date_key" in plan
    assert day.count() == fct.where(F.col("date_key") == F.lit("1997-03-05").cast("date")).count()


def test_captured_filter_reaches_the_fact_scan(spark, tmp_root):
    layout = Layout(tmp_root)
    refresh.bronze_ingest(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL))
    refresh.silver_refresh(spark, layout, "d1")
    refresh.gold_refresh(spark, layout)
    from ledgerline.operators import gold

    g = refresh.published_gold(spark, layout)
    plan = plan_of(gold.agg_cohort_ltv(g["dim_customer"], g["fct_payments"]))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,captured)" in plan
    fact_scan = [line for line in plan.splitlines() if "ReadSchema" in line and "amount_usd" in line][0]
    assert "payment_id" not in fact_scan and "method" not in fact_scan


def test_merchant_rollup_aggregates_before_the_join(spark):
    plan = plan_of(Gold.of(Lake.from_testdata(spark, SF_SMALL)).merchant_stats(), "simple")
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "Join" in line and "merchant_id" in line)
    # below the join (deeper lines), the fact side is already a partial aggregate
    assert any("partial_count" in line for line in lines[join_at:])


def test_hot_customer_join_is_split_by_adaptive_execution(spark):
    """One customer holds a third of all payments; no side is broadcast.

    Adaptive execution must split the hot customer's partition (the final plan
    shows a skew-split sort-merge join) and the result must not change.
    """
    from datetime import date, datetime
    from decimal import Decimal

    from ledgerline.operators import enrich

    n = 6000
    pays = spark.range(n).select(
        F.concat(F.lit("p"), F.col("id")).alias("payment_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"),
        F.concat(F.lit("m"), F.col("id") % 7).alias("merchant_id"),
        F.lit(Decimal("10.0000")).cast("decimal(18,4)").alias("amount_original"),
        F.lit("USD").alias("currency"),
        F.lit("captured").alias("status"),
        F.lit("card").alias("method"),
        F.lit(datetime(2024, 2, 1, 12)).cast("timestamp").alias("created_at_utc"),
        F.lit(datetime(2024, 2, 1, 12)).cast("timestamp").alias("updated_at_utc"),
    )
    customers = spark.range(500).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id")).union(
        spark.createDataFrame([("hot",)], "customer_id string")
    ).select("customer_id", F.lit(date(2024, 1, 1)).alias("signup_date"))
    merchants = spark.range(7).select(F.concat(F.lit("m"), F.col("id")).alias("merchant_id"))
    fx = spark.createDataFrame([(date(2024, 2, 1), "USD", "USD", Decimal("1.000000"))], "date date, from_ccy string, to_ccy string, rate decimal(18,6)")
    chargebacks = spark.createDataFrame([], "payment_id string, reason_code string, filed_at timestamp")

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = enrich.join_keys(pays, customers, merchants)
        assert len(joined.collect()) == n
        final = plan_of(joined, "simple")
        assert "isFinalPlan=true" in final and "skew=true" in final
        silver = enrich.enrich_payments(pays, customers, merchants, fx, chargebacks)
        assert silver.where(F.col("customer_id") == "hot").count() == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_month_is_split_across_files_by_rebalance(spark, tmp_root):
    """A month holding most of the fact is written by several tasks (one file each)
    once it exceeds the advisory partition size; small months share tasks."""
    import glob
    from datetime import date

    rows = spark.range(20000).select(
        F.concat(F.lit("p"), F.col("id")).alias("payment_id"),
        F.when(F.col("id") % 10 == 0, F.lit(date(2024, 2, 3))).otherwise(F.lit(date(2024, 1, 5))).alias("date_key"),
        (F.col("id") * 7919 % 100000).cast("string").alias("filler"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lake.write_gold(rows, Layout(tmp_root), "v1", "fct_payments")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    root = f"{tmp_root}/gold/fct_payments".replace("file:", "")
    hot = glob.glob(f"{root}/date_month=2024-01-01/version=v1/*.parquet")
    cold = glob.glob(f"{root}/date_month=2024-02-01/version=v1/*.parquet")
    assert len(hot) > 1 and len(cold) >= 1
    back = spark.read.parquet(root)
    assert back.count() == 20000 and back.where(F.col("date_month") == F.lit(date(2024, 1, 1))).count() == 18000


def test_hot_merchant_rollup_is_exact_without_broadcast(spark):
    """One merchant takes a third of all payments and nothing may be broadcast:
    the (customer, merchant) pre-aggregate collapses that merchant's repeat
    payments before the merchant join, and the totals stay exact."""
    from datetime import date
    from decimal import Decimal

    from ledgerline.operators import reports

    n = 9000
    fct = spark.range(n).select(
        F.concat(F.lit("p"), F.col("id")).alias("payment_id"),
        F.concat(F.lit("c"), F.col("id") % 300).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("merchant_id"),
        F.lit(date(2024, 2, 1)).alias("date_key"),
        F.lit(Decimal("2.5000")).cast("decimal(18,4)").alias("amount_usd"),
        F.lit("captured").alias("status"),
        (F.col("id") % 97 == 0).alias("has_chargeback"),
    )
    merchants = spark.range(50).select(
        F.concat(F.lit("m"), F.col("id")).alias("merchant_id"), F.lit("retail").alias("category"), F.lit("low").alias("risk_level")
    ).union(spark.createDataFrame([("hot", "crypto", "high")], "merchant_id string, category string, risk_level string"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        stats = reports.customer_risk_stats(fct, merchants)
        plan = plan_of(stats, "simple")
        assert "BroadcastHashJoin" not in plan and "partial_sum" in plan
        totals = stats.agg(
            F.sum("total_payments").alias("n"), F.sum("risky_volume_usd").alias("risky"), F.sum("chargebacks").alias("cb")
        ).first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert totals.n == n
    assert totals.risky == Decimal("2.5000") * (n // 3)
    assert totals.cb == len([i for i in range(n) if i % 97 == 0])


def test_fact_write_without_adaptive_execution_uses_a_range_partitioning(spark):
    from ledgerline.operators import gold

    fct = gold.fct_payments(Lake.from_testdata(spark, SF_SMALL).silver_payments)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(lake.prepare_gold(fct, "fct_payments"), "simple")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(lake.prepare_gold(fct, "fct_payments"), "simple")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "rangepartitioning(date_key" in plan


def test_hot_keys_are_split_explicitly_when_adaptive_skew_handling_is_off(spark):
    """With AQE off, rows of a hot customer join a broadcast of that customer's
    row instead of being shuffled into one task; results equal the plain join."""
    from ledgerline.operators import enrich, skew

    lake_ = Lake.from_testdata(spark, SF_SMALL)
    expected = sorted(enrich.join_keys(lake_.payments, lake_.customers, lake_.merchants).collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    old_threshold = skew.HOT_KEY_ROWS
    try:
        skew.HOT_KEY_ROWS = 40  # customers with more than 40 payments count as hot here
        joined = skew.join_splitting_hot_keys(
            lake_.payments, lake_.customers.select("customer_id", "signup_date"), "customer_id", hot_key_rows=40
        )
        plan = plan_of(joined, "simple")
        assert "LeftSemi" in plan and "LeftAnti" in plan and "Union" in plan
        hot = lake_.payments.groupBy("customer_id").count().where("count > 40").count()
        assert hot > 0
        split_df = enrich.join_keys(lake_.payments, lake_.customers, lake_.merchants)
        assert "LeftSemi" in plan_of(split_df, "simple")
        split = sorted(split_df.collect())
        flagged = enrich.drop_report(lake_.payments, lake_.customers, lake_.merchants, lake_.fx_rates).collect()
    finally:
        skew.HOT_KEY_ROWS = old_threshold
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert split == expected
    assert {r.rule: r.dropped for r in flagged}["orphan_customer"] == 57
