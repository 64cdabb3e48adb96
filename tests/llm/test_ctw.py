from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import ctw
from tests.llm.brute import low, words
from tests.llm.conftest import AWKWARD

DEPTH = ctw.DEPTH


def _held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Tree:
    """The weighting, node by node."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, node, bit in bits(text):
                for d in range(DEPTH + 1):
                    s = context[DEPTH - d :]
                    self.n[s, node][bit] += 1
                    if d:
                        self.children[s[1:], node].add(s)
        self.memo = {}

    def log_w(self, s, node):
        if (s, node) not in self.memo:
            est = _log_kt(*self.n[s, node])
            if len(s) < DEPTH:
                rest = sum(self.log_w(c, node) for c in self.children[s, node])
                top = max(est, rest)
                est = top + math.log(math.exp(est - top) + math.exp(rest - top)) - math.log(2)
            self.memo[s, node] = est
        return self.memo[s, node]

    def p(self, context, node, bit, d=0):
        s = context[DEPTH - d :]
        if (s, node) not in self.n:
            return 0.5
        n = self.n[s, node]
        kt = (n[bit] + 0.5) / (sum(n) + 1)
        if d == DEPTH:
            return kt
        stop = math.exp(_log_kt(*n) - self.log_w(s, node)) / 2
        return stop * kt + (1 - stop) * self.p(context, node, bit, d + 1)


def bits(text):
    data = b"\xff" * DEPTH + low(text or "").encode() + b"\xff"
    for i in range(DEPTH, len(data)):
        for level in range(8):
            yield data[i - DEPTH : i], (1 << level) | (data[i] >> (8 - level)), data[i] >> (7 - level) & 1


def brute(rows):
    train = [t for d, t in rows if not _held(d)]
    count = Counter(w for t in train for w in words(low(t or "")))
    n_train = sum(count.values()) + len(train)
    scale = n_train + len(count) + bool(train) + 1
    tree = Tree(train)
    out = []
    for d, t in rows:
        seen = [count[w] for w in words(low(t or ""))] + [len(train)]
        base = sum(math.log10((c + 1) / scale) for c in seen)
        score = sum(math.log10(tree.p(*b)) for b in bits(t))
        out.append((d, _held(d), len(seen), sum(c > 0 for c in seen), n_train, base, score))
    return out


def _key(row):
    return str(row)


def check(df, rows):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r) for r in ctw.ctw_scores(df).select(columns).collect()), key=lambda r: _key(r[:4] + (round(r[5], 3),)))
    want = sorted(brute(rows), key=lambda r: _key(r[:4] + (round(r[5], 3),)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_matches_brute_force(spark, doc_rows):
    rows = [(d, t) for d, t in doc_rows if d % 5 == 0 and len(t or "") < 1500]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_awkward_rows(spark):
    rows = [(d, t if d != 7 else "wörd " * 50) for d, t in AWKWARD]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int")
    check(df, rows)


def test_empty_table(awkward):
    assert ctw.ctw_scores(awkward.limit(0)).count() == 0


def test_only_held_out_documents(spark):
    ids = [i for i in range(60) if _held(i)][:3]
    df = spark.createDataFrame([(i, "ab c") for i in ids], "doc_id long, text string")
    for r in ctw.ctw_scores(df).collect():
        assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
        assert r["bits_per_byte"] == pytest.approx(8.0)


def test_held_out_text_is_compressed(docs, doc_rows):
    """Well below the order-0 entropy of the held-out bytes."""
    data = Counter(b for d, t in doc_rows if _held(d) for b in low(t or "").encode())
    n = sum(data.values())
    order0 = -sum(c * math.log2(c / n) for c in data.values()) / n
    row = ctw.ctw_scores(docs).where("held_out").selectExpr("sum(-score) * log2(10) / sum(n_bytes + 1) as bits").first()
    assert row["bits"] < 0.7 * order0
