from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, queries
from tests.llm.conftest import AWKWARD, SMALL


def grams(text, item_words=None):
    w = re.findall(r"\w+", (text or "").lower())
    n = min(5, item_words if item_words is not None else len(w)) if w else 0
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(docs, items):
    out = set()
    for item_id, item in items:
        own, n = grams(item), len(re.findall(r"\w+", (item or "").lower()))
        for doc_id, text in docs:
            if doc_id is None or item_id is None or not own:
                continue
            shared = len(own & grams(text, n))
            if shared >= 0.8 * len(own) - 1e-9:
                out.add((doc_id, item_id, len(own), shared))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_matches_brute_force(spark, docs, doc_rows, limit):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = {tuple(r) for r in decontaminate.contained_items(docs, bench, broadcast_bytes=limit).collect()}
    assert got == brute(doc_rows, items)
    assert got


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_awkward_rows(spark, awkward, limit):
    items = [(1, "three FOUR, five"), (2, "a b"), (3, None), (4, ""), (None, "short"), (5, "SHORT"), (6, "one two three four five six"),
             (7, "line that is long enough to be counted as a line surely and more of it that is not there at all")]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n_shared int")
    found = decontaminate.contained_items(awkward, bench, broadcast_bytes=limit)
    assert {tuple(r) for r in found.collect()} == brute(AWKWARD, items)
    clean = decontaminate.clean_documents(awkward, bench, broadcast_bytes=limit)
    assert clean.columns == awkward.columns
    hit = {t for _, t in AWKWARD if brute([(0, t)], items)}
    assert sorted(map(str, (r["text"] for r in clean.collect()))) == sorted(str(t) for _, t in AWKWARD if t not in hit)


def test_short_item_in_a_very_long_document(spark):
    words = [f"w{i}" for i in range(60000)]
    item = " ".join(words[30000:30030])
    edited = item.replace("w30002", "zz")
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:29990]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, edited), (3, "w1 w3 w5 w7 w9 w11")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in decontaminate.contained_items(docs, bench).collect()}
    assert got == {(1, 1, 26), (1, 2, 23)}


def test_empty_tables(spark, docs, awkward):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontaminate.contained_items(awkward.limit(0), bench).count() == 0
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == docs.count()


def test_query_returns_pairs(spark):
    out = queries.op8_decontaminate(spark, SMALL)
    assert out.columns == ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
    assert out.agg(F.min("containment")).first()[0] >= 0.8


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_short_items_with_combining_marks(spark, limit):
    """Python's words end at vowel signs and loose accents: both paths must count them alike."""
    items = [(1, "हिन्दी"), (2, "café au"), (3, "éé")]
    docs = [(i, f"vorn eins zwei drei {t} hinten vier sechs") for i, t in items] + [(9, "ohne etwas davon und mehr Worte")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for item in [*([i] for i in items), items]:  # alone, no other item brings its length
        some = bench.where(F.col("item_id").isin([i for i, _ in item]))
        found = decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), some, broadcast_bytes=limit)
        got = {tuple(r) for r in found.collect()}
        assert got == brute(docs, item) and {(i, i) for i, _ in item} <= {g[:2] for g in got}
