from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, substring_dedup as dedup
from ledgerline.llm import suffix_array as sa
from ledgerline.llm.substring_dedup import substring_dedup
from tests.llm import brute
from tests.llm.conftest import AWKWARD, SMALL


def _got(df):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    rows = df.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    return Counter(tuple(r) for r in rows)


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for trial in range(120):
        k = rng.choice([1, 2, 3, 26, 256])
        pieces = [bytes(rng.randrange(k) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 8))]
        pieces = pieces * 2 if trial % 3 == 0 else pieces
        text, _ = sa.encode(pieces)
        marks, symbols = 0, []
        for x in text.tolist():  # separators differ from each other and are ordered by position
            symbols.append((x, marks if x == sa.SEPARATOR else 0))
            marks += x == sa.SEPARATOR
        order = sa.suffix_array(text).tolist()
        assert sorted(order) == list(range(len(text)))
        plain = [i for i in range(len(text)) if text[i] >= sa.FIRST_BYTE]
        assert [i for i in order if text[i] >= sa.FIRST_BYTE] == sorted(plain, key=lambda i: symbols[i:])
        shared = sa.permuted_lcp(text, sa.suffix_array(text))
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < len(text) and symbols[a + n] == symbols[b + n]:
                n += 1
            if text[b] >= sa.FIRST_BYTE:
                assert shared[b] == n


def test_query_matches_brute_force(spark, doc_rows):
    got = queries.op10_suffix_array(spark, SMALL)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r) for r in got.select(columns).collect()) == brute.repeats(doc_rows)


@pytest.mark.parametrize("hot_rows", [4096, 1])
def test_planted_passages(spark, hot_rows):
    """Shared, overlapping and periodic passages, in odd alignments; with one row per anchor all go the hot way."""
    rng = random.Random(3)

    def noise(n, k="abcdé "):
        return "".join(rng.choice(k) for _ in range(n))

    shared = [noise(n) for n in (49, 50, 51, 80, 400)] + ["x" * 900, "ab" * 300, "y" * 49]
    rows = [
        (i, noise(rng.randint(0, 60), "uvwz") + "".join(rng.choice(shared) + noise(rng.randint(0, 9), "rst") for _ in range(4)))
        for i in range(40)
    ]
    rows += [(3, rows[5][1]), (None, rows[6][1]), (None, shared[4] + "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(substring_dedup(df, hot_rows=hot_rows)) == brute.repeats(rows)


def test_awkward_rows(awkward):
    assert _got(substring_dedup(awkward)) == brute.repeats(AWKWARD)


def test_empty_table(awkward):
    assert substring_dedup(awkward.limit(0)).count() == 0


def test_only_contents_that_may_share_a_window_are_sorted(spark, monkeypatch):
    """Strings of 16 bytes that repeat by chance, as in any large corpus, and copies of documents need no suffix array."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(1500))) for i in range(40)]
    rows += [(100 + i, text) for i, text in rows[::2]]
    staged = {}

    def keep(df, label):
        staged[label] = stage(df, label)
        return staged[label]

    stage = dedup.stage
    monkeypatch.setattr(dedup, "stage", keep)
    got = _got(substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute.repeats(rows)
    sent = [df.agg(F.sum(c)).first()[0] or 0 for df in staged.values() for c in df.columns if c in ("n_regions", "n_pieces")]
    assert sum(sent) * dedup.SIZE < 0.05 * sum(len(text) for _, text in rows)
    assert staged["repeats-judged"].count() == 0


@pytest.mark.parametrize("crowd", [16, 2])
@pytest.mark.parametrize("hot_rows", [4096, 8])
def test_shared_openings(spark, monkeypatch, hot_rows, crowd):
    """An opening of many documents, before and after texts of their own; some of those are copies, with another opening.

    Over many blocks and shards; its anchors are crowds in some blocks and not in others.
    """
    for name, value in {"BLOCK_BYTES": 1500, "SHARD_ANCHORS": 100, "SHARD_BYTES": 3000, "CROWD": crowd}.items():
        monkeypatch.setattr(dedup, name, value)
    rng = random.Random(7)
    own = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 90))) for _ in range(30)]
    opening = "Licensed under terms that many files repeat, each in its first line.\n"
    rows = [(i, rng.choice(own) + opening * rng.randint(1, 2) + own[i % 30] + opening[: rng.randint(0, 60)]) for i in range(60)]
    rows += [(None, rows[3][1]), (None, opening + "z" * 60), (7, rows[8][1] + "z" * 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _got(substring_dedup(df, hot_rows=hot_rows)) == brute.repeats(rows)


def test_names_and_shared_windows():
    rng = random.Random(11)
    contents = [bytes(rng.randrange(256) for _ in range(n)) for n in range(50, 140)]
    contents += [contents[0] + b"x", b"y" + contents[3], contents[9][:-1], contents[20][1:60]]
    data, starts = b"", []
    for between in (b"", b".."):
        for content in contents:
            starts.append(len(data))
            data += content + between
    names = dedup._names(data, np.array(starts), np.array([len(c) for c in contents] * 2))
    assert names[: len(contents)].tolist() == names[len(contents) :].tolist()
    assert len(set(names.tolist())) == len(set(contents))
    shares = [any(a[i : i + 50] in b for b in contents if b is not a for i in range(len(a) - 49)) for a in contents]
    assert dedup._share_windows(contents, 50).tolist() == shares


def test_order_of_values_that_differ_in_their_lowest_bits():
    for values in ([3, 1, 2, 1, 0], [2**63 + 1, 2**63, 5, 2**63 + 1], [7], []):
        values = np.array(values, np.uint64)
        assert values[dedup._order(values)].tolist() == sorted(values.tolist())


@pytest.mark.parametrize("hot_rows", [4096, 8])
def test_an_anchor_of_many_contents_does_not_fill_its_shard(hot_rows):
    """A block sends a crowd's anchor to the anchor's shard once, however many contents it has with it."""
    rng = random.Random(13)
    opening = "Licensed under terms that many files repeat, each in its first line.\n"
    texts = [(opening + "".join(rng.choice("abcdefgh") for _ in range(60))).encode() for _ in range(400)]
    rows = pd.DataFrame({"block": 0, "doc": range(400), "text": texts})
    named = dedup._name_contents(50, 16, 50)(rows)
    assert max(len(k) // 4 for k in named["keys"]) < 0.1 * sum(len(k) // 4 for k in named["keys"])
    whole = dedup._contents(rows, 50, 10**6)
    assert max(Counter(whole.anchor.tolist()).values()) > 300
    # The anchors' shards count a crowd's contents, so they are sent as they would be if each were named there.
    states = []
    for crowd in (16, 10**6):
        held = dedup._contents(rows, 50, crowd)
        named = dedup._name_contents(50, crowd, 50)(rows)
        told = pd.concat([dedup._compare_contents(hot_rows, 13)(g) for _, g in named.groupby("shard")])
        states.append(dedup._answered(held, told, 50)[0].tolist())
    assert states[0] == states[1]
    assert Counter(states[0])[dedup.SEND_WINDOWS if hot_rows == 8 else dedup.SEND] > 300
