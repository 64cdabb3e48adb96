"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import xxhash

SPACE = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def simhash_print(text, size):
    w = words(low(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, size=4, bits=4):
    """{(doc_id, fingerprint): component} over rows of (doc_id, text)."""
    prints = [simhash_print(t, size) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= bits
    ]
    part = components(range(len(rows)), links)
    lows = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lows[part[i]].append(doc_id)
    return Counter(
        (d, f"{prints[i]:016x}", min(lows[part[i]], default=None)) for i, (d, _) in enumerate(rows)
    )


def line_dedup(rows, min_chars=40, min_docs=5):
    """Rows of (doc_id, n_lines, n_dropped, kept text)."""
    def key(line):
        return low(line.strip(SPACE))

    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if d is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    frequent = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in frequent or frequent[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def repeats(rows, size=50):
    """{(doc_id, n_bytes, n_removed, n_spans, kept sha256)} over rows of (doc_id, text); a null id is the largest."""
    ids = [d if d is not None else 2**63 - 1 for d, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for d, b in zip(ids, data):
        for i in range(len(b) - size + 1):
            w = b[i : i + size]
            first[w] = min(first.get(w, d), d)
    out = []
    for (doc_id, _), d, b in zip(rows, ids, data):
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)
