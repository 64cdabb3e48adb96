"""License scan: MinHash bands over overlapping text windows, verified by exact shingle containment.

Words are runs of a-z and 0-9 of the lower-cased text. A window is ``window``
words, a new one every half window, so any template of up to half a window (and
a word) lies whole inside some window. Signatures are one-permutation MinHash:
the hash space of five-word shingles in ``2 ** BIN_BITS`` bins, a band the
minimum of a bin. A template's shingle in a window is the minimum of its bin
unless one of the few other shingles falls into the same bin with a smaller
hash, which has a probability below window / 2 ** (BIN_BITS + 1).

A band can match only where the window holds a template's shingle, so bands are
evaluated at those positions and nowhere else. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

WORDS = 5
CONTAINMENT = 0.8
BIN_BITS = 20

# The notices to look for.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def _shingles(words: str, size: int) -> Column:
    """XXH64 of every run of ``size`` words, in order; empty for fewer words."""
    last = F.size(words) - size
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))


def _templates(docs: DataFrame, templates: dict[str, str], size: int) -> DataFrame:
    spark = docs.sparkSession
    rows = spark.range(1).select(
        F.explode(F.map_from_arrays(*(F.array(*map(F.lit, x)) for x in (templates.keys(), templates.values())))).alias("license", "text")
    )
    rows = rows.withColumn("words", _words(F.col("text"))).withColumn("shingles", F.array_distinct(_shingles("words", size)))
    return rows.select("license", F.size("words").alias("n_words"), "shingles")


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    size: int = WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, license, n_windows, first_word, containment``: a row per document and license found in it.

    A license is found in a window that holds at least ``containment`` of its
    distinct ``size``-word shingles; ``first_word`` is where the first such
    window begins, ``containment`` the best. Templates need at least ``size``
    words each (a ValueError otherwise). Null text is empty. Rows that share an
    id (a null id counts as one) are reported together. Other columns are
    ignored; an empty table gives no rows.
    """
    known = stage(_templates(docs, templates or TEMPLATES, size), "license-templates")
    listed = known.agg(F.min("n_words").alias("low"), F.max("n_words").alias("high"), F.flatten(F.collect_set("shingles")).alias("h")).first()
    if listed["low"] < size:
        raise ValueError(f"templates need at least {size} words")
    stride = listed["high"]
    width = 2 * stride - size + 1  # shingles of a window of two strides of words
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), _words(F.col(text_column).cast("string")).alias("words"))
    rows = rows.withColumn("shingles", _shingles("words", size)).drop("words")
    wanted = sorted(set(listed["h"]))  # the templates' own shingles: as long as the templates, not the corpus
    hits = F.filter(
        F.transform("shingles", lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda s: s["h"].isin(wanted)
    )

    def windows(s: Column) -> Column:
        # The windows (one every stride) that hold the shingle at s.i, each with its shingles.
        last = F.floor(s["i"] / F.lit(stride))
        first = F.greatest(F.lit(0), F.ceil((s["i"] - width + 1) / F.lit(stride)))
        return F.transform(
            F.sequence(first.cast("int"), last.cast("int")),
            lambda w: F.struct(s["h"].alias("h"), w.alias("w"), F.slice("shingles", w * stride + 1, width).alias("held")),
        )

    # explode_outer: a filter on the array's size, given or inferred, would be pushed below the
    # projections and split the whole text again for every shingle.
    bands = rows.withColumn("hits", hits)
    bands = bands.select("doc_id", F.explode_outer(F.flatten(F.transform("hits", windows))).alias("b"))
    bands = bands.where("b is not null").select("doc_id", "b.*")

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - BIN_BITS)

    smaller = F.exists("held", lambda x: (bin_of(x) == bin_of(F.col("h"))) & (x < F.col("h")))
    bands = bands.where(~smaller)
    index = known.select("license", "shingles", F.explode("shingles").alias("h"))
    candidates = bands.join(index, "h").groupBy("doc_id", "license", "w", "held", "shingles").agg(F.lit(1).alias("one"))
    share = F.size(F.array_intersect("held", "shingles")) / F.size("shingles")
    found = candidates.withColumn("containment", share).where(F.col("containment") >= containment)
    return found.groupBy("doc_id", "license").agg(
        F.countDistinct("w").alias("n_windows"),
        (F.min("w") * stride).cast("long").alias("first_word"),
        F.max("containment").alias("containment"),
    )
