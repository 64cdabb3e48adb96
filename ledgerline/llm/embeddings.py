"""Embedding near-duplicates with a pivot-permutation index.

Pivots are reference vectors from a bounded sample, thinned so that none are
alike; their number grows with the square root of the table. A vector is
described by its ``PREFIX`` nearest pivots in order, and posted to the inverted
lists of the first ``LEAD`` of them (per label). Two vectors of a list are
candidates if their prefixes share at least ``SHARED`` pivots; only candidates
are verified, by their cosine in double precision. A pair that meets in several
lists is judged only in that of its smallest shared leading pivot.

Equal vectors are one node with a count. Candidates of a list share further
pivots beside the list's own, so a list longer than ``list_rows`` is split by a
second pivot of the prefix, and by a third where that is not enough, without
losing a candidate. What is still too long is cut into chunks, each pair of
chunks one task's group. Groups return link counts per vector and a forest of
their links, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import local_roots, stage
from ledgerline.llm.components import connected_components

COSINE = 0.93
#: Pivots of a table of n distinct vectors: ``PIVOTS_PER_ROOT * sqrt(n)``, within these bounds.
PIVOTS_PER_ROOT = 3
MIN_PIVOTS, MAX_PIVOTS = 64, 4096
PREFIX = 8
LEAD = 4
SHARED = 3
#: Distinct vectors that each pivot is chosen from (those with the smallest hashes).
SAMPLE_PER_PIVOT = 4
#: Two pivots are less alike than this.
SPREAD = 0.8
LIST_ROWS = 2000
#: Vector pairs verified at once.
VERIFY_PAIRS = 1 << 14


def pivots_for(n: int) -> int:
    """Number of pivots for ``n`` distinct vectors."""
    return min(MAX_PIVOTS, max(MIN_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(n))))


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` unit vectors, each unlike those before it (if too few are, the next ones in order)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    picked = np.empty((min(n, len(unit)), unit.shape[1]))
    rest, k = [], 0
    for i in range(len(unit)):
        if k == len(picked):
            break
        if k and (picked[:k] @ unit[i]).max() >= SPREAD:
            rest.append(i)
            continue
        picked[k] = unit[i]
        k += 1
    picked[k:] = unit[rest[: len(picked) - k]]
    return picked


def describe(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


def list_candidates(
    near: np.ndarray, lead: int, shared: int, own: list[int], left: np.ndarray, right: np.ndarray, ordered: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (one of ``left``, one of ``right``) of the list of the pivots ``own`` that share enough pivots.

    Pairs that are judged in another list are left out: those that share a
    smaller leading pivot than the list's first, or, in a split list, a smaller
    further pivot than those it was split by.
    """
    pivots, at = np.unique(near, return_inverse=True)
    at = at.reshape(near.shape)
    every = np.arange(len(near))[:, None]
    has, leads = np.zeros((2, len(near), len(pivots)), np.float32)
    has[every, at] = 1
    leads[every, at[:, :lead]] = 1
    leads = leads[:, pivots < own[0]]
    split = has[:, (pivots < max(own[1:], default=-1)) & ~np.isin(pivots, own)]
    for i in range(0, len(left), 1024):
        a = left[i : i + 1024]
        meet = has[a] @ has[right].T >= shared
        meet &= leads[a] @ leads[right].T == 0
        if len(own) > 1:
            meet &= split[a] @ split[right].T == 0
        if ordered:
            meet &= a[:, None] < right
        p, q = np.nonzero(meet)
        yield a[p], right[q]


def _postings(pivots: np.ndarray, prefix: int):
    def run(batches):
        for rows in batches:
            if len(rows):
                near = describe(np.stack(rows["embedding"].to_numpy()).astype(np.float64), pivots, prefix)
                yield rows[["node", "label", "size", "embedding"]].assign(prefix=list(near))

    return run


def _list_links(cosine: float, lead: int, shared: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        node, size = rows["node"].to_numpy(np.int64), rows["size"].to_numpy(np.int64)
        x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        norm = np.sqrt((x * x).sum(1))
        near = np.stack(rows["prefix"].to_numpy())
        p1, p2, p3, c1, c2 = (int(rows[c].iloc[0]) for c in ("p1", "p2", "p3", "c1", "c2"))
        own = [p for p in (p1, p2, p3) if p >= 0]
        chunk = rows["chunk"].to_numpy()
        left, right = np.flatnonzero(chunk == c1), np.flatnonzero(chunk == c2)
        links = np.zeros(len(rows), np.int64)
        first, second = [], []
        for a, b in list_candidates(near, lead, shared, own, left, right, c1 == c2):
            alike = np.zeros(len(a), bool)
            for i in range(0, len(a), VERIFY_PAIRS):
                s, t = a[i : i + VERIFY_PAIRS], b[i : i + VERIFY_PAIRS]
                alike[i : i + VERIFY_PAIRS] = np.einsum("ij,ij->i", x[s], x[t]) / (norm[s] * norm[t]) >= cosine
            p, q = a[alike], b[alike]
            links += np.bincount(p, size[q], len(rows)).astype(np.int64)
            links += np.bincount(q, size[p], len(rows)).astype(np.int64)
            root = local_roots(p, q, len(rows))
            moved = np.flatnonzero(root != np.arange(len(rows)))
            first.append(node[moved])
            second.append(node[root[moved]])
        some = np.flatnonzero(links)
        a, b = np.concatenate([*first, node[:0]]), np.concatenate([*second, node[:0]])
        return pd.DataFrame(
            {
                "a": np.r_[node[some], a],
                "b": np.r_[np.full(len(some), -1), b],
                "n": np.r_[links[some], np.zeros(len(a), np.int64)],
                "counted": np.r_[np.ones(len(some), bool), np.zeros(len(a), bool)],
            }
        )

    return run


LIST_KEY = ["label", "dim", "p1", "p2", "p3"]


def _lists(described: DataFrame, lead: int, shared: int, list_rows: int) -> DataFrame:
    """Every vector once per list it is judged in, with the list's ``chunks``.

    Lists of one vector are left out. Lists that are too long are split by the
    further pivots that candidates share: one, then two.
    """
    none = F.lit(-1)
    posted = described.withColumn("dim", F.size("embedding")).withColumn("p1", F.explode(F.slice("prefix", 1, lead)))
    posted = posted.withColumn("p2", none).withColumn("p3", none)
    parts = []
    for pivot in ("p2", "p3")[: shared - 1]:
        lengths = stage(posted.groupBy(LIST_KEY).agg(F.count("*").alias("n")).where("n > 1"), "pivot-lists")
        parts.append(posted.join(lengths.where(F.col("n") <= list_rows), LIST_KEY))
        long = lengths.where(F.col("n") > list_rows).drop("n")
        if long.isEmpty():
            break
        # A pair is judged where both pivots are the smallest it shares beside p1, so p3 is above p2.
        further = F.filter("prefix", lambda x: (x != F.col("p1")) & (x > F.col("p2")))
        posted = posted.join(long, LIST_KEY).withColumn(pivot, F.explode(further))
    else:
        lengths = stage(posted.groupBy(LIST_KEY).agg(F.count("*").alias("n")).where("n > 1"), "pivot-lists")
        parts.append(posted.join(lengths, LIST_KEY))
    chunks = F.ceil(F.col("n") / F.lit(list_rows)).cast("int")
    return reduce(DataFrame.unionByName, parts).withColumn("chunks", chunks).drop("n")


def _judge(
    nodes: DataFrame, pivots: np.ndarray, cosine: float, prefix: int, lead: int, shared: int, list_rows: int
) -> DataFrame:
    """(a, n) link counts where ``counted``, (a, b) links elsewhere."""
    described = nodes.mapInPandas(
        _postings(pivots, prefix), "node long, label long, size long, embedding array<double>, prefix array<int>"
    )
    dealt = _lists(stage(described, "pivot-prefixes"), lead, shared, list_rows)
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("c1", F.least("chunk", "other")).withColumn("c2", F.greatest("chunk", "other"))
    groups = dealt.select(*LIST_KEY, "c1", "c2", "chunk", "node", "size", "embedding", "prefix")
    return groups.groupBy(*LIST_KEY, "c1", "c2").applyInPandas(
        _list_links(cosine, lead, shared), "a long, b long, n long, counted boolean"
    )


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    pivots: int | None = None,
    prefix: int = PREFIX,
    lead: int = LEAD,
    shared: int = SHARED,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Rows are compared only within one label and dimension. Rows with a null id
    or label, or whose vector is null, empty, zero or holds null or non-finite
    components, link with nothing: ``n_links`` 0, ``component_id`` their own id.
    ``n_links`` counts the other rows linked directly; rows that share an id are
    rows of their own. Links found have a cosine of at least ``cosine``; the
    index may miss some (see the tests for its recall). ``pivots`` is
    ``pivots_for`` of the distinct vectors unless given. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = "vec_id is not null and label is not null and embedding is not null"
    plain = F.coalesce(fine & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # Equal vectors become one node before anything is shuffled; its id is their smallest.
    classes = rows.where(usable).where(plain).groupBy("label", "embedding").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("size")
    )
    # The number of a written row, so no two classes share one.
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "pivot-classes")
    counts, links = None, None
    for dim, n in classes.groupBy(F.size("embedding").alias("dim")).count().collect():
        own = classes.where(F.size("embedding") == dim)
        wanted = pivots or pivots_for(n)
        sample = own.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE_PER_PIVOT * wanted).collect()
        chosen = choose_pivots(np.array([r["embedding"] for r in sample], np.float64), wanted)
        few = len(chosen)
        judged = _judge(own, chosen, cosine, min(prefix, few), min(lead, few), min(shared, few), list_rows)
        judged = stage(judged, "pivot-links")
        n, l = judged.where("counted").select("a", "n"), judged.where("not counted").select("a", "b")
        counts, links = (n, l) if counts is None else (counts.unionByName(n), links.unionByName(l))
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    parts = connected_components(links, "pivot")
    sums = counts.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    known = classes.join(parts, "node", "left").join(sums, "node", "left")
    known = stage(
        known.select("label", "embedding", "low", F.coalesce("component", "node").alias("component"),
                     (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links")),
        "pivot-nodes",
    )
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = stage(known.join(lows, "component").select("label", "embedding", "component_id", "n_links"), "pivot-known")
    out = rows.join(known, ["label", "embedding"], "left")
    linked = F.col("vec_id").isNotNull() & F.col("component_id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(linked, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
