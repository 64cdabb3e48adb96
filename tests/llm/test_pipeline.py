from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate
from tests.llm import brute
from tests.llm.conftest import SMALL


def _rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_against_its_own_input(spark, docs):
    """Every stage by a plain version of its rule, on what the stage before kept."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights",
    ]
    kept = stages["quality classifier"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = labels.where("quality = 1 and toxic = 0").join(docs, "doc_id")
    assert kept.join(good, "doc_id", "left_semi").count() >= 0.95 * good.count()

    lines = stages["line dedup"](spark, kept, SMALL)
    assert lines.columns == docs.columns
    want = {(d, t) for d, _, _, t in brute.line_dedup(_rows(kept))}
    assert {(d, t or "") for d, t in _rows(lines)} == want
    assert lines.where(F.length("text") != F.col("n_chars")).count() == kept.where(F.length("text") != F.col("n_chars")).count()

    unique = stages["SimHash near-dedup"](spark, lines, SMALL)
    assert unique.columns == docs.columns
    assert {d for d, _ in _rows(unique)} == {c for _, _, c in brute.simhash(_rows(lines))}

    clean = stages["benchmark decontamination"](spark, unique, SMALL)
    found = decontaminate.contained_items(unique, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert {d for d, _ in _rows(clean)} == {d for d, _ in _rows(unique)} - {r["doc_id"] for r in found.collect()}

    mixed = stages["mixing sources to target weights"](spark, clean, SMALL)
    assert 0 < mixed.count() <= clean.count()


def test_groups_without_ids_keep_one(spark, awkward):
    out = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, awkward, SMALL)
    texts = [r["text"] for r in out.collect()]
    assert out.columns == awkward.columns
    assert texts.count("one two three four five six seven") == 1


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, docs):
    """Unrelated texts of one id both stay; a near copy of another id's text goes, whatever its id also holds."""
    long = [f"word{i} other{i * 7} third{i * 11}" for i in range(400)]
    a, b = " ".join(long[:200]), " ".join(long[200:])
    near = a.replace("word77 ", "word77 extra ", 1)
    rows = [(5, a), (5, b), (7, near), (7, "nothing like the others at all in here"), (5, a), (None, b), (None, "alone without id")]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], docs.schema)
    out = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, df, SMALL)
    assert sorted(map(str, _rows(out))) == sorted(
        map(str, [(5, a), (5, b), (7, "nothing like the others at all in here"), (None, "alone without id")])
    )


def _lake(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_whole_run_on_awkward_rows(spark, awkward, tmp_path):
    """Nulls, empty and repeated rows and a clashing column pass all stages; what comes out is of what went in."""
    sf_dir = _lake(spark, awkward.withColumn("n_chars", F.length("text")).withColumn("topic", F.lit("own")), tmp_path)
    out = corpus_pipeline.run(spark, sf_dir)
    ids = {r["doc_id"] for r in awkward.collect()}
    assert {r["doc_id"] for r in out.collect()} <= ids
    assert {"doc_id", "text", "lang", "source", "topic", "n_tokens", "probability", "weight"} <= set(out.columns)


def test_whole_run_on_an_empty_table(spark, docs, tmp_path):
    assert corpus_pipeline.run(spark, _lake(spark, docs.limit(0), tmp_path)).count() == 0
