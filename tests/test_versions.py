"""Versions by manifest, incremental gold and incremental event reconciliation."""

from __future__ import annotations

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean, events, gold
from ledgerline.plans import refresh
from ledgerline.sources import lake, testdata
from ledgerline.sources.event_index import EventIndex, IndexState, arrived_on, days_to_read
from ledgerline.sources.lake import Layout
from ledgerline.sources.versions import VersionLog, read_slices, write_slices, written_slices
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_publishers_never_share_a_number(spark, tmp_root):
    """Two publishers that both think the next number is free: both manifests stay, in the order of publishing."""
    log, late = VersionLog(spark, tmp_root), VersionLog(spark, tmp_root)
    assert log.latest() is None and log.publish({"by": "a"}) == 1
    late.numbers = lambda: []  # what it saw before the other published
    assert late.publish({"by": "b"}) == 2
    assert log.read(1) == {"by": "a"} and log.latest() == {"by": "b"}


def test_concurrent_publishers(spark, tmp_root):
    log = VersionLog(spark, tmp_root)
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(VersionLog(spark, tmp_root).publish({"by": i}))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == log.numbers() and len(got) == 6


def test_slices_of_several_versions_are_one_table(spark, tmp_root):
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 2, 1)), (3, None)], "x int, m date")
    write_slices(rows, tmp_root, "m", "a")
    write_slices(rows.where("x = 2").withColumn("x", F.lit(20)), tmp_root, "m", "b")
    assert written_slices(spark, tmp_root, "m", "b") == ["2024-02-01"]
    slices = {m: "a" for m in written_slices(spark, tmp_root, "m", "a")} | {"2024-02-01": "b"}
    table = read_slices(spark, tmp_root, "m", rows.schema["m"].dataType, slices, rows.schema)
    assert sorted(r["x"] for r in table.collect()) == [1, 3, 20]
    one = table.where(F.col("m") == F.lit(date(2024, 1, 1)))
    assert "PartitionFilters: [isnotnull(m" in plan_of(one) and [tuple(r) for r in one.collect()] == [(1, date(2024, 1, 1))]
    assert read_slices(spark, tmp_root, "m", rows.schema["m"].dataType, {}, rows.schema).count() == 0


@pytest.mark.parametrize("writer", ["write_outcomes", "write_silver"])
def test_a_silver_run_that_fails_midway_leaves_the_old_silver_whole(spark, tmp_root, monkeypatch, writer):
    layout = Layout(tmp_root)
    raw = testdata.raw_tables(spark, SF_SMALL)
    refresh.bronze_ingest(spark, layout, "d1", raw)
    refresh.silver_refresh(spark, layout, "d1")
    before = {t: sorted(map(str, lake.read_silver(spark, layout, t).collect())) for t in lake.published_silver(spark, layout)}
    assert set(before) == {"customers", "merchants", "payments", "payments_rejected", "chargebacks", "fx_rates", "blacklist", "events"}

    other = {t: df.limit(20) if t in ("customers", "payments", "events", "chargebacks") else df for t, df in raw.items()}
    refresh.bronze_ingest(spark, layout, "d2", other)
    real = getattr(lake, writer)

    def failing(df, layout_, run, table="payments"):
        if table in ("payments", "blacklist"):
            raise RuntimeError("disk full")
        return real(df, layout_, run, table)

    monkeypatch.setattr(lake, writer, failing)
    with pytest.raises(RuntimeError, match="disk full"):
        refresh.silver_refresh(spark, layout, "d2")
    assert before == {t: sorted(map(str, lake.read_silver(spark, layout, t).collect())) for t in before}

    monkeypatch.setattr(lake, writer, real)
    refresh.silver_refresh(spark, layout, "d2")
    assert lake.read_silver(spark, layout, "customers").count() == 20
    assert lake.read_silver(spark, layout, "customers", number=1).count() == len(before["customers"])


def test_silver_that_fails_its_gate_is_not_published(spark, tmp_root):
    from ledgerline.operators.quality import SuiteFailed

    layout = Layout(tmp_root)
    raw = dict(testdata.raw_tables(spark, SF_SMALL))
    refresh.bronze_ingest(spark, layout, "d1", raw)
    refresh.silver_refresh(spark, layout, "d1", gate=True)
    doubled = raw | {"merchants": raw["merchants"].union(raw["merchants"])}
    refresh.bronze_ingest(spark, layout, "d2", doubled)
    with pytest.raises(SuiteFailed):
        refresh.silver_refresh(spark, layout, "d2", gate=True)
    assert lake.read_silver(spark, layout, "merchants").count() == 10


def test_gold_writes_the_changed_month_only(spark, tmp_root):
    layout = Layout(tmp_root)
    raw = dict(testdata.raw_tables(spark, SF_SMALL))
    first = refresh.full_refresh(spark, layout, "d1", raw, ())["gold_version"]
    assert {e["version"] for e in lake.gold_manifest(spark, layout)["months"].values()} == {first}
    # One payment of one month is gone, another month's payments all are.
    gone = (F.col("created_at").startswith("1996-05")) | (F.col("payment_id") == _some_payment(spark, layout))
    raw["payments"] = raw["payments"].where(~gone)
    second = refresh.full_refresh(spark, layout, "d2", raw, ())["gold_version"]
    months = lake.gold_manifest(spark, layout)["months"]
    assert [m for m, e in months.items() if e["version"] == second] == ["1997-03-01"]
    assert "1996-05-01" not in months and len(months) > 50
    fct = refresh.published_gold(spark, layout)["fct_payments"]
    silver = lake.read_silver(spark, layout, "payments")
    assert fct.count() == silver.count() and fct.select("payment_id").exceptAll(silver.select("payment_id")).count() == 0
    # The version before is still there, whole.
    old = lake.read_gold(spark, layout, "fct_payments", first)
    assert old.count() == 3245
    # Nothing changed: no month is written.
    third = refresh.gold_refresh(spark, layout)
    assert third not in {e["version"] for e in lake.gold_manifest(spark, layout)["months"].values()}
    assert refresh.published_gold(spark, layout)["fct_payments"].count() == fct.count()


def test_cohort_mart_takes_unchanged_months_over(spark, tmp_root):
    layout = Layout(tmp_root)
    raw = dict(testdata.raw_tables(spark, SF_SMALL))
    payments, gate = raw["payments"], ("gold_fct_payments",)

    def run(**tables):
        refresh.full_refresh(spark, layout, "d1", raw | tables, gate)
        published = refresh.published_gold(spark, layout)
        whole = gold.agg_cohort_ltv(published["dim_customer"], published["fct_payments"])
        mart = published["agg_cohort_ltv"]
        assert mart.exceptAll(whole).isEmpty() and whole.exceptAll(mart).isEmpty()
        return lake.gold_manifest(spark, layout)["cohort_months_read"]

    assert run(payments=payments.where("created_at < '1997-03-15'")) is None
    # Months go, come and change; a customer is new.
    rest = payments.where("created_at not like '1996-05%' and created_at < '1997-05'")
    newcomer = raw["customers"].limit(1).withColumn("customer_id", F.lit("newcomer"))
    assert run(payments=rest, customers=raw["customers"].union(newcomer)) == ["1997-03-01", "1997-04-01"]
    # A customer without a change of payments moves to another cohort: all cells may change.
    moved = raw["customers"].withColumn("signup_date", F.concat(F.lit("1980"), F.substring("signup_date", 5, 6)))
    assert run(payments=rest, customers=moved) is None


def test_cohorts_kept(spark):
    def dim(*rows):
        return spark.createDataFrame([(c, date.fromisoformat(m) if m else None) for c, m in rows], "customer_id string, cohort_month date")

    a, b = ("a", "2024-01-01"), ("b", None)
    assert gold.cohorts_kept(dim(a, b), dim(b, a, ("c", "2024-03-01")))
    assert gold.cohorts_kept(dim(), dim(a))
    assert not gold.cohorts_kept(dim(a, b), dim(a))
    assert not gold.cohorts_kept(dim(a, b), dim(a, ("b", "2024-01-01")))
    assert not gold.cohorts_kept(dim(a), dim(a, a))


def _some_payment(spark, layout):
    march = lake.read_gold(spark, layout, "fct_payments").where("date_month = date'1997-03-01'")
    return march.agg(F.min("payment_id")).first()[0]


EVENT = "event_id string, customer_id string, type string, event_ts string"


def _landing(spark, rows):
    return spark.createDataFrame(rows, EVENT + ", kafka_ts string").select(
        "*", F.to_date("kafka_ts").alias("arrival_date")
    )


def test_reconcile_reads_changed_days_and_equals_the_full_union(spark, tmp_root):
    index, state = EventIndex(spark, f"{tmp_root}/index", 4), IndexState(buckets=4)
    day1 = [("e1", "c1", "login", "t5", "2024-01-01"), ("e2", "c2", "login", "t2", "2024-01-01"), (None, "x", "y", "z", "2024-01-01")]
    day2 = [("e3", "c3", "login", "t3", "2024-01-02")]
    day9 = [("e4", "c4", "login", "t4", "2024-01-09"), ("e2", "c2", "login", "t9", "2024-01-09")]
    late = [("e1", "c1", "login", "t1", "2024-01-01")]  # an earlier copy, arriving late on an old day
    no_time = [("e6", "c6", "login", "t6", None)]
    batch0 = spark.createDataFrame([], EVENT)
    batch1 = spark.createDataFrame([("e2", "c2", "login", "t7"), ("e5", "c5", "login", "t0")], EVENT)
    steps = [
        (batch0, day1 + day2, ["2024-01-01", "2024-01-02"]),
        (batch0, day1 + day2 + day9, ["2024-01-09"]),
        (batch1, day1 + day2 + day9 + late, ["2024-01-01", "2024-01-09"]),
        (batch1, day1 + day2 + day9 + late + no_time, ["", "2024-01-09"]),
        (batch1, day1 + day2 + day9 + late + no_time, ["", "2024-01-09"]),
    ]
    for batch, rows, days in steps:
        landing = _landing(spark, rows)
        state, read = index.reconcile(batch, landing, state, replay_days=1)
        assert read == days
        got = index.events(state.batches)
        want = events.union_dedupe(batch, landing)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # A run that is not published leaves no trace, and a repeated run adds nothing.
    index.reconcile(spark.createDataFrame([("e9", "c", "t", "t")], EVENT), landing, state)
    assert index.events(state.batches).count() == 6
    again, _ = index.reconcile(batch1, landing, state)
    assert spark.table(index.name).where(F.col("batch") == again.batches[-1]).count() == 0


def test_batches_are_folded(spark, tmp_root, monkeypatch):
    from ledgerline.sources import event_index

    monkeypatch.setattr(event_index, "MAX_BATCHES", 3)
    index, state = EventIndex(spark, f"{tmp_root}/index", 2), IndexState(buckets=2)
    for i in range(5):
        batch = spark.createDataFrame([(f"e{i}", "c", "t", "1"), ("e0", "c", "t", str(9 - i))], EVENT)
        state, _ = index.reconcile(batch, _landing(spark, []), state)
        assert len(state.batches) <= 3
    assert sorted(r["event_id"] for r in index.events(state.batches).collect()) == [f"e{i}" for i in range(5)]
    assert index.events(state.batches).where("event_id = 'e0'").first()["event_ts"] == "1"


def test_days_to_read():
    known = {"2024-01-01": 5, "2024-01-02": 7, "2024-02-01": 1}
    now = known | {"2024-01-01": 6, "2024-02-02": 1}
    assert days_to_read(now, known, 0) == ["2024-01-01", "2024-02-02"]
    assert days_to_read(now, known, 2) == ["2024-01-01", "2024-02-01", "2024-02-02"]
    assert days_to_read(now, now, 0) == [] and days_to_read({}, {}, 2) == []


def test_index_is_joined_without_a_shuffle_and_days_are_pruned(spark, tmp_root):
    layout = Layout(tmp_root)
    _landing(spark, [("e1", "c", "t", "1", "2024-01-01"), ("e2", "c", "t", "1", "2024-01-02")]).write.partitionBy(
        "arrival_date"
    ).parquet(layout.stream_landing)
    landing = refresh.read_stream_landing(spark, layout)
    days = plan_of(landing.where(arrived_on(["2024-01-02"])))
    pruned = days.split("PartitionFilters: [")[1].split("]")[0]
    assert "arrival_date" in pruned and "2024-01-02" in pruned
    index = EventIndex(spark, f"{tmp_root}/index", 4)
    state, _ = index.reconcile(spark.createDataFrame([], EVENT), landing, IndexState(buckets=4))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = events.ranked(spark.createDataFrame([("e1", "c", "t", "0")], EVENT), landing).repartition(4, "event_id")
        joined = new.join(index.best(state.batches).withColumnRenamed("survivor", "known"), "event_id", "left")
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # The last branch of the join is the index: nothing is exchanged below it.
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    margin = lines[join].index("SortMergeJoin")
    index_side = next(i for i in range(join + 1, len(lines)) if lines[i][margin:].startswith("+- "))
    assert "Bucketed: true" in plan and "Exchange" in "".join(lines[join:index_side])
    assert "Exchange" not in "".join(lines[index_side:])
    assert "Exchange" not in plan_of(index.events(state.batches))


def test_events_of_a_refresh_accumulate_run_by_run(spark, tmp_root):
    """Three refreshes over a growing landing: silver events and the quarantine equal the full recomputation."""
    from ledgerline.plans import io_jobs

    layout = Layout(tmp_root)
    raw = testdata.raw_tables(spark, SF_SMALL)
    messages = testdata.event_messages(spark, SF_SMALL)
    bad = spark.createDataFrame([("{no", "2024-05-05 00:00:00"), ("{no", None)], "value string, timestamp string").select(
        "value", F.col("timestamp").cast("timestamp").alias("timestamp")
    )
    day = F.pmod(F.datediff(F.to_date("timestamp"), F.lit("1970-01-01").cast("date")), F.lit(2))
    for run, landed in enumerate([messages.where(day == 0), messages.where(day == 1).unionByName(bad), messages.limit(5)]):
        io_jobs._land_messages(spark, landed, layout)
        refresh.bronze_ingest(spark, layout, f"d{run}", raw)
        refresh.silver_refresh(spark, layout, f"d{run}")
        landing = refresh.read_stream_landing(spark, layout)
        want = clean.clean_events(events.union_dedupe(raw["events"], landing))
        got = lake.read_silver(spark, layout, "events")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        lost = lake.read_silver(spark, layout, "events_quarantine")
        assert lost.count() == events.quarantine(raw["events"], landing).count() == (2 if run else 0)
