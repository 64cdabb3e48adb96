from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, queries
from tests.llm.conftest import SMALL


def test_query_matches_sql(spark, run_oracle):
    columns, want = run_oracle(queries.ORACLE_SQL["op9_mixing"])
    got = queries.op9_mixing(spark, SMALL).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want)) and got


def test_margins_meet_the_targets(spark, docs):
    rows = docs.withColumn("topic", mixing.topic()).withColumn("n_tokens", mixing.token_count())
    cells = mixing.mixed_cells(rows.select(*mixing.DIMENSIONS, "n_tokens"), 0.5, 0.5, 25, None)
    want = cells.withColumn("w", F.col("tokens") * F.col("probability") * F.col("weight"))
    total = cells.agg(F.sum("tokens")).first()[0]
    for d in mixing.DIMENSIONS:
        sums = want.groupBy(d).agg(F.sum("tokens").alias("n"), F.sum("w").alias("w")).collect()
        norm = sum(r["n"] ** 0.5 for r in sums)
        for r in sums:
            assert r["w"] == pytest.approx(total / 2 * r["n"] ** 0.5 / norm, rel=2e-2)


def test_given_targets(spark, docs):
    langs = spark.createDataFrame([("en", 3.0), ("de", 1.0)], "lang string, share double")
    out = mixing.mix_sources(docs, targets={"lang": langs})
    assert {r["lang"] for r in out.select("lang").distinct().collect()} <= {"en", "de"}


def test_shuffled_join_gives_the_same(spark, docs, monkeypatch):
    want = mixing.mix_sources(docs).select("doc_id", "weight").collect()
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    assert Counter(mixing.mix_sources(docs).select("doc_id", "weight").collect()) == Counter(want)


def test_awkward_rows(spark, awkward):
    named = awkward.withColumn("source", F.when(F.col("doc_id") > 3, "a")).withColumn("weight", F.lit("x"))
    out = mixing.mix_sources(named, fraction=1.0, power=1.0)
    assert out.count() == awkward.count()  # the whole corpus at its own shares
    assert dict(out.dtypes)["weight"] == "double"
    assert mixing.mix_sources(named.limit(0)).count() == 0


def test_main_path_is_native(spark, docs):
    plan = mixing.mix_sources(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_margins_hold_with_the_querys_parameters(spark, docs):
    rows = docs.withColumn("topic", mixing.topic()).withColumn("n_tokens", mixing.token_count())
    cells = mixing.mixed_cells(rows.select(*mixing.DIMENSIONS, "n_tokens"), mixing.FRACTION, mixing.POWER, mixing.ROUNDS, None)
    cells = [(r, r["tokens"] * r["probability"] * r["weight"]) for r in cells.collect()]
    for d in mixing.DIMENSIONS:
        tokens, got = Counter(), Counter()
        for r, w in cells:
            tokens[r[d]] += r["tokens"]
            got[r[d]] += w
        norm = sum(n**mixing.POWER for n in tokens.values())
        for value, n in tokens.items():
            want = sum(tokens.values()) * mixing.FRACTION * n**mixing.POWER / norm
            assert got[value] == pytest.approx(want, rel=1.01 * mixing.TOLERANCE)


def test_targets_that_cannot_hold_together_raise(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 9)
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (2, "c d", "t", "de")], "doc_id long, text string, source string, lang string")
    sources = spark.createDataFrame([("s", 1.0), ("t", 1.0)], "source string, share double")
    langs = spark.createDataFrame([("en", 3.0), ("de", 1.0)], "lang string, share double")
    with pytest.raises(ValueError, match="off their targets"):
        mixing.mix_sources(docs, targets={"source": sources, "lang": langs})
