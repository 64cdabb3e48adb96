"""Jobs that ingest payments several times derive them once; what a refresh has counted it does not count again."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.plans import io_jobs, refresh
from ledgerline.sources import lake, testdata

ORDERS = [(1, 1, "1996-05-01"), (2, 2, "1997-03-09"), (3, 1, "1998-08-20"), (4, None, "1997-03-30"), (2, 1, "1999-01-02"), (None, 1, "1999-01-02")]
LINES = [(1, 1, 1, 10.5), (1, 2, 1, 0.01), (2, 1, 1, 7.25), (2, 1, 2, 1.25), (3, 1, 2, 99.99), (4, 3, 1, 5.0), (None, 1, 1, 3.0)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    orders = [(k, c, datetime.fromisoformat(d)) for k, c, d in ORDERS]
    write("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    write("lineitem", LINES, "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double")
    write("customer", [(1, 2, "AUTO"), (2, 3, "HOME")], "c_custkey long, c_nationkey int, c_mktsegment string")
    write("supplier", [(1,), (2,)], "s_suppkey long")
    write("events", [(1, datetime(1999, 1, 1), 1, "click")], "event_id long, ts timestamp_ntz, user_id long, event_type string")
    return folder


def test_written_lines_give_the_same_raw_rows(spark, tables):
    lines = testdata.written_payment_lines(spark, tables)
    for table in ("payments", "chargebacks"):
        derived, written = (testdata.raw_table(spark, tables, table, given) for given in (None, lines))
        assert written.schema == derived.schema
        assert sorted(written.collect(), key=str) == sorted(derived.collect(), key=str)
    assert lines.count() == 6  # the repeated order's line counts twice, the null key not at all


def _reads_lines(df) -> bool:
    return any("lineitem" in f for f in df.inputFiles())


def test_bronze_overwrite_derives_payments_once(spark, tables, monkeypatch):
    ingested, real = [], lake.write_bronze

    def write(df, *args):
        ingested.append(_reads_lines(df))
        return real(df, *args)

    monkeypatch.setattr(lake, "write_bronze", write)
    rows = io_jobs.bronze_partition_overwrite(spark, tables).collect()
    assert sorted(map(tuple, rows)) == [("2001-12-30", 6, 5), ("2001-12-31", 6, 5)]
    assert ingested == [False] * 5


@pytest.mark.parametrize("job", ["versions_expired", "gold_incremental", "cohort_ltv_incremental"])
def test_refreshes_derive_payments_once(spark, tables, monkeypatch, job):
    class Enough(Exception):
        pass

    seen = {}

    def first_refresh(spark_, layout, ds, raw, gates):
        seen.update(raw)
        raise Enough

    monkeypatch.setattr(refresh, "full_refresh", first_refresh)
    with pytest.raises(Enough):
        io_jobs.IO_QUERIES[job](spark, tables)
    assert not _reads_lines(seen["payments"]) and not _reads_lines(seen["chargebacks"])


def test_prints_are_sums_of_whole_hashes(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("p_"), F.col("id") % 300).alias("payment_id"),
        F.when(F.col("id") % 7 > 0, F.expr("date_add(date'2020-01-20', cast(id % 40 as int))")).alias("date_key"),
        (F.col("id") / 3).cast("decimal(18,4)").alias("amount_usd"),
    )
    hashed = rows.select(
        F.trunc("date_key", "MM").cast("string").alias("month"), *(F.xxhash64(F.lit(s), *rows.columns).alias(f"h{s}") for s in (1, 2))
    )
    expected = {}
    for month, a, b in hashed.collect():
        n, x, y = expected.get(month, (0, 0, 0))
        expected[month] = (n + 1, x + a, y + b)
    found = lake.month_prints(rows.withColumn(lake.MONTH_COLUMN, F.trunc("date_key", "MM")))
    assert found == {m: {"rows": n, "print": [str(x), str(y)]} for m, (n, x, y) in expected.items()}
    assert None in found and len(found) == 3


def test_a_refresh_counts_the_keys_of_the_fact_once(spark, tables, monkeypatch, tmp_path):
    counted, real = [], quality.duplicate_rows

    def duplicates(df, columns):
        if columns == ["payment_id"]:
            counted.append(df)
        return real(df, columns)

    monkeypatch.setattr(quality, "duplicate_rows", duplicates)
    layout = lake.Layout(str(tmp_path))
    raw = testdata.raw_tables(spark, tables)
    raw["payments"] = raw["payments"].dropDuplicates(["payment_id"])
    refresh.full_refresh(spark, layout, "d", raw, ("gold_fct_payments",))
    assert len(counted) == 1
    gold = refresh.published_gold(spark, layout).tables
    names = ["table_name", "kind", "constraint_name", "violations"]
    whole, known = (
        {tuple(r) for r in quality.constraint_report(gold, unique).select(names).collect()} for unique in ((), {"fct_payments"})
    )
    assert whole == known
    twice = gold | {"fct_payments": gold["fct_payments"].unionAll(gold["fct_payments"])}
    with pytest.raises(quality.ConstraintsViolated, match="unique.payment_id"):
        quality.enforce_constraints(twice)
    with pytest.raises(quality.SuiteFailed, match="unique.payment_id"):
        quality.validate(twice["fct_payments"], "gold_fct_payments")
