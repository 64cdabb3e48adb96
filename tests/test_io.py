"""Layer I/O, staged gold publish and the streaming landing."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import refresh
from ledgerline.sources import lake, testdata
from ledgerline.sources.lake import Layout
from ledgerline.streaming import landing
from tests.conftest import SF_SMALL


def test_bronze_rerun_overwrites_only_its_partition(spark, tmp_root):
    layout = Layout(tmp_root)
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    lake.write_bronze(df, layout, "t", "2024-01-01")
    lake.write_bronze(df.limit(1), layout, "t", "2024-01-02")
    lake.write_bronze(df, layout, "t", "2024-01-01")
    assert lake.read_bronze(spark, layout, "t", "2024-01-01").count() == 2
    day2 = lake.read_bronze(spark, layout, "t", "2024-01-02")
    assert day2.count() == 1 and "_ingested_at" in day2.columns and "dt" not in day2.columns


def test_failed_gold_refresh_keeps_previous_version(spark, tmp_root, monkeypatch):
    layout = Layout(tmp_root)
    refresh.bronze_ingest(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL))
    refresh.silver_refresh(spark, layout, "d1")
    first = refresh.gold_refresh(spark, layout)
    before = refresh.published_gold(spark, layout)["agg_daily_kpis"].count()

    real = lake.write_gold

    def failing(df, layout_, version, table):
        if table == "agg_cohort_ltv":
            raise RuntimeError("disk full")
        return real(df, layout_, version, table)

    monkeypatch.setattr(lake, "write_gold", failing)
    with pytest.raises(RuntimeError):
        refresh.gold_refresh(spark, layout)
    assert lake.current_gold_version(spark, layout) == first
    assert refresh.published_gold(spark, layout)["agg_daily_kpis"].count() == before


def test_publish_keeps_what_was_published_until_it_is_committed(spark, tmp_root):
    layout = Layout(tmp_root)
    lake.publish_gold(spark, layout, "v1")
    folder = f"{layout.gold_root}/_versions"
    first = {n for n in os.listdir(folder) if n.endswith(".json")}
    # What a publish leaves behind that dies before its commit.
    with open(f"{folder}/.draft-unfinished", "w") as f:
        f.write('{"version": "unfini')
    assert lake.current_gold_version(spark, layout) == "v1"
    lake.publish_gold(spark, layout, "v2")
    assert lake.current_gold_version(spark, layout) == "v2"
    assert first < {n for n in os.listdir(folder) if n.endswith(".json")}
    lake.publish_gold(spark, layout, "v1")
    assert lake.current_gold_version(spark, layout) == "v1"


def test_refresh_without_stream_uses_batch_events_only(spark, tmp_root):
    layout = Layout(tmp_root)
    refresh.bronze_ingest(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL))
    assert refresh.read_stream_landing(spark, layout) is None
    drops = refresh.silver_refresh(spark, layout, "d1")
    assert lake.read_silver(spark, layout, "events").count() == 1000
    assert drops["pre_signup"] == 796 and drops["missing_fx"] == 162
    assert lake.read_silver(spark, layout, "payments").count() == 3245


def _drop(inbox: str, name: str, messages: list[tuple[str, str]]) -> None:
    os.makedirs(inbox, exist_ok=True)
    with open(f"{inbox}/{name}.json", "w") as f:
        for value, when in messages:
            f.write(json.dumps({"value": value, "timestamp": when}) + "\n")


def test_stream_landing_runs_new_nothing_new_replay(spark, tmp_root):
    layout = Layout(tmp_root)
    inbox = f"{tmp_root}/inbox"
    e1 = json.dumps({"event_id": "e1", "customer_id": "c1", "type": "login", "event_ts": "2024-01-01T00:00:00+00:00"})
    e2 = json.dumps({"event_id": "e2", "customer_id": "c2", "type": "login", "event_ts": "2024-01-01T00:01:00+00:00"})

    def run():
        landing.land_events(landing.file_messages(spark, inbox), layout.stream_landing, layout.stream_checkpoint).awaitTermination()
        return landing.read_landing(spark, layout.stream_landing)

    _drop(inbox, "a", [(e1, "2024-01-01T00:00:01.000000Z"), (e2, "2024-01-01T00:01:01.000000Z")])
    assert run().count() == 2
    assert run().count() == 2  # nothing new: nothing written
    _drop(inbox, "b", [(e1, "2024-01-02T00:00:01.000000Z")])  # replayed message
    landed = run()
    assert landed.count() == 3 and landed.select("event_id").distinct().count() == 2


def test_malformed_message_lands_as_null_row_and_is_quarantined(spark, tmp_root):
    layout = Layout(tmp_root)
    inbox = f"{tmp_root}/inbox"
    _drop(inbox, "a", [("{not json", "2024-01-01T00:00:01.000000Z")])
    landing.land_events(landing.file_messages(spark, inbox), layout.stream_landing, layout.stream_checkpoint).awaitTermination()
    row = landing.read_landing(spark, layout.stream_landing).first()
    assert row.event_id is None and row.kafka_ts is not None
    refresh.bronze_ingest(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL))
    refresh.silver_refresh(spark, layout, "d1")
    (lost,) = lake.read_silver(spark, layout, "events_quarantine").collect()
    assert lost.source == "stream" and lost.raw_value == "{not json" and lost.kafka_ts is not None
    assert lake.read_silver(spark, layout, "events").where(F.col("event_id").isNull()).count() == 0


def test_csv_and_jsonl_round_trip(spark, tmp_root):
    from ledgerline.schemas import EVENTS, PAYMENTS
    from ledgerline.sources import raw

    pays = testdata.raw_payments(spark, SF_SMALL)
    raw.write_csv(pays, f"{tmp_root}/p")
    back = raw.read_csv_raw(spark, f"{tmp_root}/p", PAYMENTS)
    assert back.exceptAll(pays).count() == 0 and back.count() == 4599
    ev = testdata.raw_events(spark, SF_SMALL)
    raw.write_jsonl(ev, f"{tmp_root}/e")
    assert raw.read_jsonl_raw(spark, f"{tmp_root}/e", EVENTS).exceptAll(ev).count() == 0


def test_landing_folder_round_trip_and_cli_refresh(spark, tmp_root):
    from ledgerline.__main__ import main
    from ledgerline.sources import raw

    raw.write_landing(testdata.raw_tables(spark, SF_SMALL), testdata.denylist_documents(spark, SF_SMALL), f"{tmp_root}/raw")
    landed = raw.read_landing(spark, f"{tmp_root}/raw", multi_line_denylist=False)
    expected = testdata.raw_tables(spark, SF_SMALL)
    for table in raw.LANDING_FILES:
        assert landed[table].exceptAll(expected[table]).count() == 0, table
        assert landed[table].count() == expected[table].count(), table
    rc = main(["refresh", "--root", f"{tmp_root}/lake", "--ds", "d1", "--raw-dir", f"{tmp_root}/raw",
               "--denylist-format", "lines", "--gate", "silver_payments", "--gate", "gold_fct_payments"])
    assert rc == 0
    assert refresh.published_gold(spark, Layout(f"{tmp_root}/lake"))["fct_payments"].count() == 3245
    assert main(["validate", "bronze_payments", "--root", f"{tmp_root}/lake", "--ds", "d1"]) == 1


def test_cli_stream_report_and_constraints(spark, tmp_root, capsys):
    from ledgerline.__main__ import main
    from ledgerline.sources import raw

    raw.write_jsonl(testdata.event_messages(spark, SF_SMALL), f"{tmp_root}/inbox/a")
    assert main(["stream", "--root", f"{tmp_root}/lake", "--inbox", f"{tmp_root}/inbox/*"]) == 0
    assert landing.read_landing(spark, f"{tmp_root}/lake/bronze/events_stream").count() == 1000

    layout = Layout(f"{tmp_root}/lake")
    refresh.full_refresh(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL), testdata.PASSING_GATES)
    assert lake.read_silver(spark, layout, "events").count() == 1200  # batch 1000 + 200 of the stream alone
    capsys.readouterr()
    assert main(["report", "chargeback_rate_by_merchant", "--root", f"{tmp_root}/lake", "--rows", "5"]) == 0
    assert "chargeback_rate_pct" in capsys.readouterr().out
    assert main(["constraints", "--root", f"{tmp_root}/lake"]) == 0
    out = capsys.readouterr().out
    assert "fk(customer_id->dim_customer.customer_id)" in out


def test_rerun_of_a_run_date_is_idempotent(spark, tmp_root):
    layout = Layout(tmp_root)
    first = refresh.full_refresh(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL), testdata.PASSING_GATES)
    kpis_1 = sorted(refresh.published_gold(spark, layout)["agg_daily_kpis"].collect())
    second = refresh.full_refresh(spark, layout, "d1", testdata.raw_tables(spark, SF_SMALL), testdata.PASSING_GATES)
    assert first["bronze"] == second["bronze"] and first["silver_drops"] == second["silver_drops"]
    assert second["gold_version"] != first["gold_version"]
    assert lake.current_gold_version(spark, layout) == second["gold_version"]
    assert sorted(refresh.published_gold(spark, layout)["agg_daily_kpis"].collect()) == kpis_1
    assert lake.read_bronze(spark, layout, "payments", "d1").count() == 4599


def test_empty_datasets_do_not_break_the_refresh(spark, tmp_root):
    """A day without chargebacks leaves an empty bronze partition; a day without any
    data leaves empty partitioned gold. Both must read back as empty tables."""
    raw = dict(testdata.raw_tables(spark, SF_SMALL))
    raw["chargebacks"] = raw["chargebacks"].limit(0)
    layout = Layout(f"{tmp_root}/no-chargebacks")
    out = refresh.full_refresh(spark, layout, "d1", raw, gates=("silver_payments", "gold_fct_payments"))
    assert out["bronze"]["chargebacks"] == 0
    fct = refresh.published_gold(spark, layout)["fct_payments"]
    assert fct.count() == 3245 and fct.where("has_chargeback").count() == 0

    empty = {t: df.limit(0) for t, df in testdata.raw_tables(spark, SF_SMALL).items()}
    layout = Layout(f"{tmp_root}/empty")
    refresh.full_refresh(spark, layout, "d1", empty, gates=("silver_payments", "gold_fct_payments"))
    g = refresh.published_gold(spark, layout)
    assert g["fct_payments"].count() == 0 and g["dim_date"].count() == 0
    assert g.fraud_signals().count() == 0 and g.ltv_by_cohort().count() == 0


def test_gates_are_on_by_default_and_a_refused_run_does_not_publish(spark, tmp_root):
    from ledgerline.operators.quality import ConstraintsViolated, SuiteFailed

    raw = dict(testdata.raw_tables(spark, SF_SMALL))
    with pytest.raises(SuiteFailed, match="bronze_payments"):
        refresh.full_refresh(spark, Layout(f"{tmp_root}/a"), "d1", raw)

    layout = Layout(f"{tmp_root}/b")
    first = refresh.full_refresh(spark, layout, "d1", raw, testdata.PASSING_GATES)["gold_version"]
    doubled = raw | {"customers": raw["customers"].union(raw["customers"].where("customer_id = 'c_4'"))}
    with pytest.raises((ConstraintsViolated, SuiteFailed)):
        refresh.full_refresh(spark, layout, "d2", doubled, ("gold_fct_payments",))
    longer = raw | {"customers": raw["customers"].withColumn("country", F.lit("ARG"))}
    with pytest.raises(ConstraintsViolated, match=r"varchar\(country,2\)"):
        refresh.full_refresh(spark, layout, "d3", longer, testdata.PASSING_GATES)
    assert lake.current_gold_version(spark, layout) == first
    quotes = raw | {"fx_rates": raw["fx_rates"].union(raw["fx_rates"].limit(1))}
    refresh.bronze_ingest(spark, layout, "d4", quotes)
    with pytest.raises(ConstraintsViolated, match="fx_rates"):
        refresh.silver_refresh(spark, layout, "d4")


def test_lines_that_do_not_fit_are_rescued_and_stay_rows(spark, tmp_root):
    from ledgerline.schemas import EVENTS, PAYMENTS
    from ledgerline.sources import raw

    head = ",".join(PAYMENTS.names)
    lines = [
        "p1,c1,m1,10.5,USD,captured,2024-01-01,2024-01-01,card",
        "p2,c1,m1,ten,USD,captured,2024-01-01,2024-01-01,card",  # a bad cell
        "p3,c1",  # too short
        "p4,c1,m1,1,USD,captured,2024-01-01,2024-01-01,card,extra",  # too long
        'p5,c1,m1,1,USD,captured,2024-01-01,2024-01-01,"a, b"',
        "p6,c1,m1,,USD,captured,2024-01-01,2024-01-01,",  # nulls fit
    ]
    Path(f"{tmp_root}/p.csv").write_text("\n".join([head, *lines]) + "\n")
    objects = ['{"event_id":"e1","customer_id":"c","type":"t","event_ts":"x"}', '{"event_id":"e2",', "", "[]", '{"other":1}']
    Path(f"{tmp_root}/e.jsonl").write_text("\n".join(objects) + "\n")
    raw_tables = {t: df.limit(0) for t, df in testdata.raw_tables(spark, SF_SMALL).items()}
    raw_tables["payments"] = raw.read_csv_raw(spark, f"{tmp_root}/p.csv", PAYMENTS, rescue=True)
    raw_tables["events"] = raw.read_jsonl_raw(spark, f"{tmp_root}/e.jsonl", EVENTS, rescue=True)
    layout = Layout(f"{tmp_root}/lake")
    counts = refresh.bronze_ingest(spark, layout, "d1", raw_tables)
    assert counts["payments"] == 6 and counts["events"] == 4 - 1  # "[]" holds no object
    found = {r.payment_id: r._rescued for r in lake.read_rescued(spark, layout, "payments", "d1").collect()}
    assert found == {"p2": lines[1], "p3": lines[2], "p4": lines[3]}
    amounts = {r.payment_id: r.amount for r in lake.read_bronze(spark, layout, "payments", "d1").collect()}
    assert amounts == {"p1": 10.5, "p2": None, "p3": None, "p4": 1.0, "p5": 1.0, "p6": None}
    assert [r._rescued for r in lake.read_rescued(spark, layout, "events", "d1").collect()] == [objects[1]]
    assert lake.read_rescued(spark, layout, "customers", "d1").isEmpty()  # landed without the column
