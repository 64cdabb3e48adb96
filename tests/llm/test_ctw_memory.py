"""What the workers of the context-tree weighting hold at once."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd

from ledgerline.llm import ctw
from ledgerline.llm.packs import unpack


def _block():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(400)]
    held = [i % 7 == 2 for i in range(400)]
    return texts, pd.DataFrame({"doc_id": range(400), "text": texts, "block": 0, "held_out": held})


def test_a_block_is_named_within_a_few_times_its_text():
    texts, rows = _block()
    tracemalloc.start()
    try:
        asked = ctw._ask(4)(rows.copy())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10 * sum(map(len, texts))
    named = asked[asked["kind"] == ctw.STRINGS]
    total = sum(int(unpack(c, np.int64).sum()) for c in named["counts"])
    assert total == sum(len(t) + 1 for i, t in enumerate(texts) if i % 7 != 2)


def test_counts_of_many_chunks_add_up(monkeypatch):
    monkeypatch.setattr(ctw, "COUNT_CHUNK", 50)
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab ", k=rng.randrange(120))) for _ in range(60)] + [b""]
    keys, counts = ctw._count_codes(texts)
    expected = Counter(int(c) for t in texts for c in ctw._codes(t))
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == expected
    assert (np.diff(keys.astype(object)) > 0).all()
