from __future__ import annotations

from collections import Counter

from ledgerline.llm import line_dedup, queries
from ledgerline.llm.common import table
from tests.llm import brute
from tests.llm.conftest import AWKWARD, SMALL


def _got(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in df.collect())


def test_matches_brute_force(docs, doc_rows):
    assert _got(line_dedup.line_dedup(docs)) == brute.line_dedup(doc_rows)


def test_awkward_rows(awkward):
    out = line_dedup.line_dedup(awkward)
    assert _got(out) == brute.line_dedup(AWKWARD)
    assert set(out.columns) == {*awkward.columns, "n_dropped"}


def test_empty_table(awkward):
    assert line_dedup.line_dedup(awkward.limit(0)).count() == 0


def test_query_matches_sql(spark, run_oracle):
    columns, want = run_oracle(queries.ORACLE_SQL["op4_line_dedup"])
    got = queries.op4_line_dedup(spark, SMALL).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_runs_are_merged_level_by_level(spark):
    """Seven batches at fanout two: runs of levels 0, 1 and 2, and the state of all batches."""
    lines = table(spark, SMALL, "documents").selectExpr("doc_id", "xxhash64(text) % 5 as h1", "0L as h2")
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(7):
        runs.add(lines.where(f"doc_id % 7 = {i}"))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    got = {(r["h1"], r["n_docs"], r["keeper"]) for r in runs.state().collect()}
    want = {
        (r[0], r[1], r[2])
        for r in lines.groupBy("h1").agg({"doc_id": "count"}).join(
            lines.groupBy("h1").agg({"doc_id": "max"}), "h1"
        ).collect()
    }
    assert got == want


def test_new_batch_is_screened_by_the_runs_before(spark):
    runs = line_dedup.LineRuns(spark)
    runs.add(spark.createDataFrame([(i, 1, 1) for i in range(5)] + [(9, 2, 2)], "doc_id long, h1 long, h2 long"))
    batch = spark.createDataFrame([(3, 1, 1), (4, 1, 1), (10, 2, 2)], "doc_id long, h1 long, h2 long")
    assert [tuple(r) for r in runs.screen(batch, 5).collect()] == [(3, 1, 1)]


def test_a_batch_is_anti_joined_in_its_buckets_and_enters_counts_only(spark):
    """Ids fed in either order give the same state; fed downwards, lines known before enter without a keeper."""
    lines = spark.createDataFrame([(i, i % 3, 0) for i in range(12)], "doc_id long, h1 long, h2 long")
    want = {(0, 4, 9), (1, 4, 10), (2, 4, 11)}
    for down in (True, False):
        runs = line_dedup.LineRuns(spark, fanout=9)
        for i in sorted(range(3), reverse=down):
            runs.add(lines.where(f"doc_id div 4 = {i}"))
        assert {(r["h1"], r["n_docs"], r["keeper"]) for r in runs.state().collect()} == want
        later = [r["keeper"] for run in runs.runs()[1:] for r in runs._table(run).collect()]
        assert all(k is None for k in later) == down
    batch = lines.groupBy("h1", "h2").agg({"doc_id": "max"}).selectExpr("h1", "h2", "1L as n_docs", "`max(doc_id)` as keeper")
    plan = runs.anti_joined(batch)._jdf.queryExecution().executedPlan().toString()
    moved = plan.count("Exchange hashpartitioning(h1") - plan.count("ReusedExchange")
    assert plan.count("SortMergeJoin") == 3 and moved <= 2 and "BroadcastExchange" not in plan  # the batch alone


def test_a_later_job_takes_the_runs_up(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=8)
    rows = spark.createDataFrame([(i, 1, 1) for i in range(5)] + [(9, 2, 2)], "doc_id long, h1 long, h2 long")
    for i in range(3):
        runs.add(rows.where(f"doc_id % 3 = {i}"))
    again = line_dedup.LineRuns(spark, root=runs.root)
    assert again.levels == runs.levels and (again.fanout, again.buckets) == (2, 8)
    again.add(spark.createDataFrame([(20, 1, 1)], rows.schema))
    assert {tuple(r) for r in again.state().collect()} == {(1, 1, 6, 20), (2, 2, 1, 9)}


def test_nothing_but_null_ids(spark):
    rows = [(None, "x" * 50), (None, "x" * 50)]
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=1)
    assert [(r["n_lines"], r["n_dropped"]) for r in out.collect()] == [(1, 0)] * 2
