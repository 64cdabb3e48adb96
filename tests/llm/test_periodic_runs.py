from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import periodic_runs, queries
from ledgerline.llm.common import table
from tests.llm import brute
from tests.llm.conftest import AWKWARD, SMALL


def brute_runs(words, least=12):
    """Every lag, word by word; a stretch counts with its smallest period."""
    x = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.empty(0, int)
    found = {}
    for q in range(1, len(x) // 2 + 1):
        same = np.r_[False, x[q:] == x[:-q], False].astype(int)
        begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for a, b in zip(begin.tolist(), (end + q).tolist()):
            if b - a >= max(least, 2 * q):
                found.setdefault((a, b), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def judged(texts):
    return [
        ([tuple(map(int, r)) for r in runs], kept.decode())
        for runs, kept in periodic_runs.runs_of_texts([t.encode() for t in texts])
    ]


def check(texts):
    for text, (runs, kept) in zip(texts, judged(texts), strict=True):
        words = brute.words(text)
        want = brute_runs(words)
        assert runs == want, (text[:200], runs[:5], want[:5])
        assert kept == " ".join(brute_collapsed(words, want))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


def test_random_words_of_small_alphabets():
    rng = random.Random(1)
    texts = [
        " ".join(rng.choice("abcdefgh"[:k]) for _ in range(rng.randint(0, 400)))
        for k in (1, 2, 3, 5, 8) for _ in range(25)
    ]
    check(texts)


def test_structured_words():
    words = [fibonacci(1500), thue_morse(1500), "a" * 1000, "ab" * 600 + "a", "a" * 500 + "b" + "a" * 500]
    words += [("a" * i + "b") * 4 for i in (70, 130, 300)]
    words += [(("ab" * i) + "a") * 2 for i in (33, 70, 150)]  # squares whose root is itself periodic
    words += [("ab" * 200 + "a") + ("ab" * 150 + "a") + "c" + ("ab" * 90 + "a") * 3]
    words += [("abc" * 40 + "d") * 5 + ("abc" * 40) * 2, fibonacci(300) * 3 + "c" + thue_morse(256) * 4]
    check([" ".join(w) for w in words])


@pytest.mark.parametrize("seed", range(3))
def test_planted_long_periods(seed):
    """Periods at and about the bounds of scan and scales, at exponents from 2 on."""
    rng = random.Random(seed)
    texts = []
    for p in [5, 6, 7, 11, 12, 31, 63, 64, 65, 127, 128, 129, 200, 255, 256, 257, 511, 512, 700]:
        root = [f"w{rng.randrange(10 ** rng.choice((1, 3, 6)))}" for _ in range(p)]
        n = rng.choice([2 * p - 1, 2 * p, 2 * p + 1, 3 * p + rng.randrange(p)])
        around = [[f"v{rng.randrange(9)}" for _ in range(rng.randrange(300))] for _ in range(2)]
        texts.append(" ".join(around[0] + [root[i % p] for i in range(n)] + around[1]))
    check(texts)


def test_nested_runs():
    """Runs of runs: a repeated block that holds runs of its own at three levels."""
    rng = random.Random(9)
    inner = ["a", "b"] * 20 + ["c"]
    middle = inner * 4 + [f"x{rng.randrange(50)}" for _ in range(30)]
    outer = middle * 3 + [f"y{rng.randrange(50)}" for _ in range(10)]
    check([" ".join(outer * 2), " ".join((outer * 2)[7:-9])])


def test_query_matches_brute_force(spark):
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = brute.words(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        row = got[doc_id]
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == want
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        kept = " ".join(brute_collapsed(words, runs))
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert planted > 5


def test_awkward_rows(awkward):
    out = periodic_runs.periodic_runs(awkward)
    got = sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect())
    want = []
    for doc_id, text in AWKWARD:
        words = brute.words(text or "")
        runs = [(0, 20000, 1)] if len(words) == 20000 else brute_runs(words)
        want.append((str(doc_id), runs, " ".join(brute_collapsed(words, runs))))
    assert got == sorted(want)
    assert out.columns == ["doc_id", "runs", "collapsed"]


def test_empty_table(awkward):
    assert periodic_runs.periodic_runs(awkward.limit(0)).count() == 0


def test_very_long_texts_take_time_in_proportion():
    """Texts of one word, of two alternating ones and of one long period: half a million words each."""
    root = [str(i) for i in range(1000)]
    n = 500_000
    texts = [" ".join(["a"] * n), " ".join(["a", "b"] * (n // 2)), " ".join(root * (n // 1000))]
    assert [r for r, _ in judged(texts)] == [[(0, n, 1)], [(0, n, 2)], [(0, n, 1000)]]
