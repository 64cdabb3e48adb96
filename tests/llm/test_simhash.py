from __future__ import annotations

import random
from collections import Counter

import pytest

from ledgerline.llm import simhash
from tests.llm import brute
from tests.llm.conftest import AWKWARD


def _got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_matches_brute_force(docs, doc_rows):
    assert _got(simhash.simhash_groups(docs)) == brute.simhash(doc_rows)


def test_awkward_rows(awkward):
    assert _got(simhash.simhash_groups(awkward)) == brute.simhash(AWKWARD)


def test_empty_table(awkward):
    assert simhash.simhash_groups(awkward.limit(0)).count() == 0


def test_xxh64_of_spark_and_of_the_operator_agree(spark):
    row = spark.sql("select xxhash64('a b c d') as h").first()
    assert int(simhash.shingle_hashes(b"A b  c\td", 4)[0]) == row["h"] % (1 << 64)


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_links_of_planted_fingerprints(spark, bucket_rows):
    """Chains and clusters of fingerprints; with two rows a bucket, all go the way of hot buckets."""
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(6):
            prints.add(p)
            for _ in range(rng.randint(1, 6)):
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    want = brute.components(
        prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    )
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(df, 4, bucket_rows).collect()]
    assert brute.components(prints, links) == want
    assert all((a ^ b).bit_count() <= 4 for a, b in links) or bucket_rows == 4096
