from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import embeddings
from tests.llm import brute


def exact(rows, cosine=0.93):
    """{row number: (vec_id, n_links, component)} by all pairs, and all links."""
    ok = [
        i for i, (v, e, l) in enumerate(rows)
        if v is not None and l is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    ]
    links = []
    groups = {}
    for i in ok:
        groups.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], np.float64)
        n = np.sqrt((x * x).sum(1))
        a, b = np.nonzero(np.triu((x @ x.T) / (n[:, None] * n) >= cosine, 1))
        links += [(members[p], members[q]) for p, q in zip(a, b)]
    degree = Counter(i for link in links for i in link)
    part = brute.components(range(len(rows)), links)
    low = {}
    for i in ok:
        low[part[i]] = min(low.get(part[i], rows[i][0]), rows[i][0])
    return [(r[0], degree[i], low.get(part[i], r[0]) if i in set(ok) else r[0]) for i, r in enumerate(rows)], len(links)


def _got(df, **options):
    out = embeddings.near_vectors(df, **options)
    assert out.where("kept != coalesce(vec_id = component_id, false)").count() == 0
    return [tuple(r) for r in out.select("vec_id", "n_links", "component_id").collect()]


def _clusters():
    rng = np.random.default_rng(7)
    vectors = [rng.normal(size=16) for _ in range(150)]
    for centre in [rng.normal(size=16) for _ in range(6)]:
        vectors += [centre + rng.normal(size=16) * rng.uniform(0.05, 0.35) for _ in range(25)]
    return [(i, [float(np.float32(x)) for x in v], int(i % 10 == 0)) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("pivots", [None, 12])
def test_recall_and_precision(spark, pivots):
    """Clusters of near vectors among random ones; lists that are split and cut give the links of whole lists."""
    rows = _clusters()
    want, n_links = exact(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = _got(df, pivots=pivots)
    assert n_links > 500 and sum(n for _, n, _ in got) >= 0.98 * 2 * n_links
    true = {v: n for v, n, _ in want}
    assert all(n <= true[v] for v, n, _ in got)
    assert sorted(_got(df, pivots=pivots, list_rows=30)) == sorted(got)


def _borderline(n, dim, pairs, rng):
    """Random unit vectors; the last ``pairs`` are partners of the first at a cosine of 0.93 to 0.95."""
    x = rng.normal(size=(n - pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base, aside = x[:pairs], rng.normal(size=(pairs, dim))
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cos = rng.uniform(0.9301, 0.95, size=(pairs, 1))
    return np.r_[x, cos * base + np.sqrt(1 - cos**2) * aside]


@pytest.mark.parametrize("dim", [16, 64])
def test_few_pairs_are_compared(dim):
    """Verified pairs of one label with the query's own parameters: a small share that falls as the table grows."""
    shares = []
    for n in (1750, 7000):
        x = _borderline(n, dim, 500, np.random.default_rng(dim))
        wanted = embeddings.pivots_for(n)
        near = embeddings.describe(x, embeddings.choose_pivots(x[::-1][: 4 * wanted], wanted), embeddings.PREFIX)
        compared, found = 0, set()
        for pivot in range(wanted):
            rows = np.flatnonzero((near[:, : embeddings.LEAD] == pivot).any(1))
            every = np.arange(len(rows))
            for p, q in embeddings.list_candidates(
                near[rows], embeddings.LEAD, embeddings.SHARED, [pivot], every, every, True
            ):
                compared += len(p)
                found.update(zip(rows[p].tolist(), rows[q].tolist(), strict=True))
        assert compared == len(found)  # no pair twice
        shares.append(compared / (n * (n - 1) / 2))
        assert np.mean([(i, n - 500 + i) in found for i in range(500)]) >= 0.95
    assert shares[1] < 0.02 and shares[1] < 0.7 * shares[0]


def test_query_recall_on_borderline_pairs(spark):
    """More vectors than pivots, links that only just count, the query's own parameters."""
    rng = np.random.default_rng(3)
    x = _borderline(3000, 32, 400, rng)
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(x)]
    want, n_links = exact(rows)
    got = _got(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    true = {v: n for v, n, _ in want}
    assert all(n <= true[v] for v, n, _ in got)
    assert n_links >= 390 and sum(n for _, n, _ in got) >= 0.95 * 2 * n_links


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_recall_on_the_given_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    want, n_links = exact(rows)
    got = {v: n for v, n, _ in _got(df)}
    assert all(got[v] <= n for v, n, _ in want)
    assert sum(got.values()) >= 0.95 * 2 * n_links


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0),
        (7, [1.0, None, 3.0], 0), (8, [float("nan"), 1.0, 1.0], 0), (9, [float("inf"), 1.0, 1.0], 0), (None, v, 0),
        (10, [], 0), (11, [1.0, 2.0], 0), (12, [1.0, 2.1], 0), (2, [2.0, 4.0, 6.0], 0), (13, [-1.0, 5.0, 0.0], 0), (13, v, 0),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    assert Counter(_got(df)) == Counter(exact(rows)[0])


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert _got(df) == []
