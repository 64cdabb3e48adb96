"""Quality suites and gold constraints on clean and deliberately broken input."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerline.operators import quality
from ledgerline.plans.catalog import Gold, Lake
from tests.conftest import SF_SMALL

BRONZE = "payment_id string, customer_id string, merchant_id string, amount double, currency string, status string, created_at string, updated_at string, method string"


def test_unknown_suite_raises_key_error(spark):
    with pytest.raises(KeyError):
        quality.suite_report(spark.range(1), "no_such_suite")


def test_bronze_suite_counts_every_rule(spark):
    rows = [
        ("p1", "c1", "m1", 10.0, "USD", "captured", "t", "t", "card"),
        ("p1", "c1", "m1", 0.001, "CLP", "lost", "t", "t", "cash"),
        (None, None, None, 200000.0, None, None, "t", "t", None),
        ("p2", "c2", "m2", None, "EUR", "pending", "t", "t", "wallet"),
    ]
    report = {r.position: r for r in quality.suite_report(spark.createDataFrame(rows, BRONZE), "bronze_payments").collect()}
    counts = [report[i].unexpected_count for i in range(1, 9)]
    # not_null id, unique id (both p1 rows), not_null customer, not_null merchant,
    # currency, status, method (NULLs skipped), amount range (NULL skipped)
    assert counts == [1, 2, 1, 1, 1, 1, 1, 2]
    with pytest.raises(quality.SuiteFailed, match="bronze_payments"):
        quality.validate(spark.createDataFrame(rows, BRONZE), "bronze_payments")


def test_silver_and_gold_suites_pass_on_testdata(spark):
    lake = Lake.from_testdata(spark, SF_SMALL)
    assert len(quality.validate(lake.silver_payments, "silver_payments")) == 11
    assert len(quality.validate(lake.fct_payments, "gold_fct_payments")) == 7


def test_bronze_suite_fails_on_testdata_by_design(spark):
    lake = Lake.from_testdata(spark, SF_SMALL)
    report = {r.expectation + ":" + r.column_name: r.unexpected_count for r in quality.suite_report(lake.raw["payments"], "bronze_payments").collect()}
    assert report["in_set:currency"] == 214 and report["between:amount"] == 850


def test_constraint_report_clean_then_broken(spark):
    g = Gold.of(Lake.from_testdata(spark, SF_SMALL))
    clean = quality.constraint_report(g.tables).collect()
    assert sum(r.violations for r in clean) == 0 and len(clean) == 79

    tables = dict(g.tables)
    fct = tables["fct_payments"]
    dup = fct.limit(1)
    tables["fct_payments"] = fct.unionByName(dup)
    tables["dim_merchant"] = tables["dim_merchant"].limit(0)
    tables["agg_daily_kpis"] = spark.createDataFrame(
        [(date(1900, 1, 1), 1, 1, 0, 0, Decimal("1.50000"), None, Decimal("1.0000"), Decimal("1.0000"), 1, 1)],
        tables["agg_daily_kpis"].schema,
    )
    broken = {(r.table_name, r.constraint_name): r.violations for r in quality.constraint_report(tables).collect()}
    assert broken[("fct_payments", "unique(payment_id)")] == 2
    assert broken[("fct_payments", "fk(merchant_id->dim_merchant.merchant_id)")] == fct.count() + 1
    assert broken[("agg_daily_kpis", "fk(date_key->dim_date.date_key)")] == 1
    assert broken[("agg_daily_kpis", "check(auth_rate BETWEEN 0 AND 1)")] == 1
    assert broken[("agg_daily_kpis", "not_null(chargeback_rate)")] == 1
