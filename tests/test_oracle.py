"""Every registered query against its DuckDB oracle, and the fixture's row counts."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.io_jobs import IO_QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare

LAKE_KEYS = {*QUERIES, *IO_QUERIES}
ORACLE_KEYS = sorted(LAKE_KEYS & set(entry.oracle_sql()))


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_query_matches_oracle(spark, key):
    result = compare(spark, SF_SMALL, [key])[key]
    assert result["match"], result


def test_every_query_has_an_oracle():
    assert set(ORACLE_KEYS) == LAKE_KEYS <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 892 and "auth_rate_pct" in df.columns


def test_fixture_counts_sf0001(spark):
    from ledgerline.plans.catalog import Lake

    lake = Lake.from_testdata(spark, SF_SMALL)
    assert lake.payments.count() == 4599
    assert lake.customers.count() == 150 and lake.merchants.count() == 10
    assert lake.chargebacks.count() == 130 and lake.denylist.count() == 3 and lake.fx_rates.count() == 12785
    silver = lake.silver_payments
    assert silver.count() == 3245
    assert silver.agg(F.sum("amount_usd")).first()[0] == Decimal("111164423.2981")
    assert lake.dim_date.count() == 2371 and lake.agg_cohort_ltv.count() == 828
    assert lake.events.count() == 1200 and lake.events_batch_only.count() == 1000


def test_mapping_invariants(spark):
    """Generator-style invariants of the raw mapping: chargebacks only on captured or
    refunded payments and filed after them; payment ids unique; deterministic."""
    from ledgerline.sources import testdata

    pays = testdata.raw_payments(spark, SF_SMALL)
    cbs = testdata.raw_chargebacks(spark, SF_SMALL)
    joined = cbs.join(pays.select("payment_id", "status", "created_at"), "payment_id", "left")
    assert joined.where(F.col("status").isNull()).count() == 0
    assert joined.where(~F.col("status").isin("captured", "refunded")).count() == 0
    assert joined.where(F.to_timestamp("filed_at") <= F.to_timestamp("created_at")).count() == 0
    assert pays.select("payment_id").distinct().count() == pays.count() == 4599
    again = testdata.raw_payments(spark, SF_SMALL)
    assert pays.exceptAll(again).count() == 0 and again.exceptAll(pays).count() == 0
