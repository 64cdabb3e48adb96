"""Edge cases, one per semantic trap (bad input, duplicates, empty input, calendar)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerline.operators import clean, enrich, events, gold, reports
from ledgerline.sources import raw as raw_io
from tests.test_transforms import FACT, frames, payment, ts


def test_malformed_date_and_amount_become_null(spark):
    customers = spark.createDataFrame([("c1", "2024-13-45", "AR", "x")], "customer_id string, signup_date string, country string, marketing_channel string")
    assert clean.clean_customers(customers).first().signup_date is None
    pays = spark.createDataFrame(
        [("p1", "c1", "m1", 1e30, "USD", "captured", "not a time", "2024-01-01T00:00:00+00:00", "card")],
        "payment_id string, customer_id string, merchant_id string, amount double, currency string, status string, created_at string, updated_at string, method string",
    )
    row = clean.clean_payments(pays).first()
    assert row.amount_original is None and row.created_at_utc is None and row.updated_at_utc is not None


def test_swapped_csv_columns_fail_loudly(spark, tmp_root):
    from ledgerline.schemas import CUSTOMERS

    path = f"{tmp_root}/customers.csv"
    with open(path, "w") as f:
        f.write("signup_date,customer_id,country,marketing_channel\n2024-01-01,c1,AR,x\n")
    with pytest.raises(Exception):
        raw_io.read_csv_raw(spark, path, CUSTOMERS).collect()


def test_two_chargebacks_duplicate_a_payment(spark):
    cbs = [("p1", "FRAUD", ts(2024, 2, 5)), ("p1", "DISPUTED", ts(2024, 2, 6))]
    p, c, m, fx, cb = frames(spark, [payment()], chargebacks=cbs)
    out = enrich.enrich_payments(p, c, m, fx, cb)
    assert out.count() == 2 and out.where("has_chargeback").count() == 2
    from ledgerline.operators.quality import suite_report

    unique = [r for r in suite_report(out, "silver_payments").collect() if r.expectation == "unique"][0]
    assert unique.unexpected_count == 2 and unique.success is False


def test_foreign_quote_currency_is_ignored(spark):
    fx = [(date(2024, 2, 1), "BRL", "EUR", Decimal("0.18")), (date(2024, 2, 1), "BRL", "USD", Decimal("0.2"))]
    p, c, m, fxd, cb = frames(spark, [payment()], fx=fx)
    rows = enrich.enrich_payments(p, c, m, fxd, cb).collect()
    assert len(rows) == 1 and rows[0].amount_usd == Decimal("15.0000")


def test_missing_rate_drops_and_is_counted(spark):
    p, c, m, fx, cb = frames(spark, [payment(), payment(pid="p2", ccy="CLP")])
    assert enrich.enrich_payments(p, c, m, fx, cb).count() == 1
    report = {r.rule: r.dropped for r in enrich.drop_report(p, c, m, fx).collect()}
    assert report == {"orphan_customer": 0, "orphan_merchant": 0, "null_date": 0, "pre_signup": 0, "missing_fx": 1}


def test_outcomes_hold_every_payment_and_the_kept_equal_plain(spark):
    pays = [payment(), payment(pid="p2", ccy="CLP"), payment(pid="p3", cust="ghost"), payment(pid="p4", created=ts(2023, 1, 1))]
    ghost = payment(pid="p5")
    pays += [(*ghost[:2], "ghost", *ghost[3:]), payment(pid="p6", created=None), payment(pid=None), payment(pid="p2", ccy=None)]
    twice = [(pid, "fraud", ts(2024, 3, 1)) for pid in ("p1", "p1", "p2", "p3")]
    p, c, m, fx, cb = frames(spark, pays, chargebacks=twice)
    out = enrich.payments_by_outcome(p, c, m, fx, cb)
    plain = enrich.enrich_payments(p, c, m, fx, cb).collect()
    kept = out.where("outcome = 'kept'").drop("outcome").collect()
    assert sorted(map(str, kept)) == sorted(map(str, plain)) and len(plain) == 3  # p1 twice, and the payment without an id
    rejected = out.where("outcome != 'kept'")
    assert sorted((r.payment_id, r.outcome) for r in rejected.collect()) == [
        ("p2", "missing_fx"), ("p2", "missing_fx"), ("p3", "orphan_customer"), ("p4", "pre_signup"),
        ("p5", "orphan_merchant"), ("p6", "null_date"),
    ]
    assert rejected.where("amount_usd is not null or has_chargeback").isEmpty()


def test_chargebacks_can_exceed_captured_and_zero_captured_rate_is_zero(spark):
    d1, d2 = date(2024, 2, 1), date(2024, 2, 2)
    rows = [
        (d1, "captured", Decimal("1"), "c1", "m1", True),
        (d1, "refunded", Decimal("1"), "c1", "m1", True),
        (d2, "refused", Decimal("1"), "c1", "m1", False),
    ]
    k = {r.date_key: r for r in gold.agg_daily_kpis(spark.createDataFrame(rows, FACT)).collect()}
    assert k[d1].chargeback_rate == Decimal("2.00000") and k[d1].auth_rate == Decimal("0.50000")
    assert k[d2].chargeback_rate == Decimal("0.00000") and k[d2].auth_rate == Decimal("0.00000")


def test_empty_payments_give_an_empty_calendar(spark):
    empty = spark.createDataFrame([], FACT)
    assert gold.dim_date(empty).count() == 0


def test_calendar_is_gap_free_with_iso_week_and_monday_zero(spark):
    rows = [(date(2024, 12, 28), "captured", Decimal("1"), "c1", "m1", False), (date(2025, 1, 2), "captured", Decimal("1"), "c1", "m1", False)]
    cal = {r.date_key: r for r in gold.dim_date(spark.createDataFrame(rows, FACT)).collect()}
    assert len(cal) == 6
    dec30 = cal[date(2024, 12, 30)]
    assert (dec30.year, dec30.week_of_year, dec30.day_of_week, dec30.day_name, dec30.month_name) == (2024, 1, 0, "Monday", "December")
    assert cal[date(2024, 12, 28)].is_weekend is True and cal[date(2024, 12, 29)].day_of_week == 6


def test_cohort_months_are_calendar_months_and_not_cumulative(spark):
    dim = spark.createDataFrame([("c1", date(2024, 1, 31))], "customer_id string, signup_date date")
    dim = dim.selectExpr("customer_id", "signup_date", "trunc(signup_date, 'MM') as cohort_month")
    rows = [
        (date(2024, 2, 1), "captured", Decimal("10.0000"), "c1", "m1", False),
        (date(2024, 2, 20), "captured", Decimal("5.0000"), "c1", "m1", False),
        (date(2024, 4, 1), "captured", Decimal("1.0000"), "c1", "m1", False),
        (date(2024, 4, 2), "refused", Decimal("100.0000"), "c1", "m1", False),
    ]
    cells = {r.months_since_signup: r for r in gold.agg_cohort_ltv(dim, spark.createDataFrame(rows, FACT)).collect()}
    assert set(cells) == {1, 3}
    assert cells[1].total_ltv_usd == Decimal("15.0000") and cells[1].active_customers == 1
    assert cells[3].total_ltv_usd == Decimal("1.0000")


def test_fraud_signal_count_is_null_when_volume_is_zero(spark):
    stats = spark.createDataFrame(
        [("c1", 1, 0, Decimal("0.0000"), Decimal("0.0000"))],
        "customer_id string, total_payments long, chargebacks long, total_volume_usd decimal(28,4), risky_volume_usd decimal(28,4)",
    )
    dim = spark.createDataFrame([("c1", "AR", date(2024, 1, 1), True)], "customer_id string, country string, cohort_month date, is_blacklisted boolean")
    row = reports.fraud_signals(stats, dim).first()
    assert row.signal_blacklist is True and row.signal_risky_merchants is None and row.signals_triggered is None


def test_union_dedupe_keeps_batch_copy_and_quarantines_malformed(spark):
    schema = "event_id string, customer_id string, type string, event_ts string"
    batch = spark.createDataFrame([("e1", "c1", "login", "2024-01-01T00:00:00+00:00")], schema)
    stream = spark.createDataFrame(
        [("e1", "c9", "login", "2024-01-01T00:00:00+00:00", None), ("e2", "c2", "kyc_submit", "2024-01-02T00:00:00+00:00", None), (None, None, None, None, None)],
        schema + ", kafka_ts timestamp",
    )
    out = {r.event_id: r for r in events.union_dedupe(batch, stream).collect()}
    assert set(out) == {"e1", "e2"} and out["e1"].customer_id == "c1"
    unnamed = spark.createDataFrame([(None, "c7", "login", "2024-01-03T00:00:00+00:00")], schema)
    lost = {r.source: r for r in events.quarantine(batch.union(unnamed), stream).collect()}
    assert set(lost) == {"batch", "stream"} and '"c7"' in lost["batch"].raw_value


def test_denylist_document_is_exploded(spark, tmp_root):
    path = f"{tmp_root}/denylist.json"
    with open(path, "w") as f:
        f.write('{\n  "blacklisted_customer_ids": ["c1", "c2", "c1"],\n  "updated_at": "2024-03-31T23:59:59+00:00"\n}\n')
    rows = raw_io.read_denylist(spark, path).collect()
    assert [r.customer_id for r in rows] == ["c1", "c2", "c1"]
    assert {r.blacklist_updated_at for r in rows} == {"2024-03-31T23:59:59+00:00"}
    assert clean.distinct_denylist(raw_io.read_denylist(spark, path)).count() == 2


def test_null_payment_date_is_its_own_drop_rule(spark):
    p, c, m, fx, cb = frames(spark, [payment(), payment(pid="p2", created=None), payment(pid="p3", created=ts(2023, 6, 1))])
    report = {r.rule: r.dropped for r in enrich.drop_report(p, c, m, fx).collect()}
    assert report["null_date"] == 1 and report["pre_signup"] == 1
    assert enrich.enrich_payments(p, c, m, fx, cb).count() == 1


def test_tiny_payment_rounds_to_zero_usd_and_fails_the_silver_gate(spark):
    from ledgerline.operators.quality import SuiteFailed, validate

    p, c, m, fx, cb = frames(spark, [payment(amount="0.0001")])
    silver = enrich.enrich_payments(p, c, m, fx, cb)
    assert silver.first().amount_usd == Decimal("0.0000")
    with pytest.raises(SuiteFailed, match=r"between\(amount_usd\)=1"):
        validate(silver, "silver_payments")


def test_required_field_missing_in_csv_reads_as_null_and_the_suite_catches_it(spark, tmp_root):
    from ledgerline.operators.quality import suite_report
    from ledgerline.schemas import PAYMENTS

    path = f"{tmp_root}/payments.csv"
    with open(path, "w") as f:
        f.write("payment_id,customer_id,merchant_id,amount,currency,status,created_at,updated_at,method\n")
        f.write("p1,,m1,10.5,USD,captured,2024-01-01T00:00:00+00:00,2024-01-01T00:00:00+00:00,card\n")
        f.write("p2,c2,m1,abc,USD,captured,2024-01-01T00:00:00+00:00,2024-01-01T00:00:00+00:00,card\n")
    df = raw_io.read_csv_raw(spark, path, PAYMENTS)
    rows = {r.payment_id: r for r in df.collect()}
    assert rows["p1"].customer_id is None and rows["p2"].amount is None
    report = {(r.expectation, r.column_name): r.unexpected_count for r in suite_report(df, "bronze_payments").collect()}
    assert report[("not_null", "customer_id")] == 1


def test_pending_and_refunded_lower_the_authorisation_rate(spark):
    d = date(2024, 2, 1)
    rows = [(d, "captured", Decimal("1"), "c1", "m1", False), (d, "pending", Decimal("1"), "c2", "m1", False)]
    k = gold.agg_daily_kpis(spark.createDataFrame(rows, FACT)).first()
    assert k.auth_rate == Decimal("0.50000") and k.refused_payments == 0
