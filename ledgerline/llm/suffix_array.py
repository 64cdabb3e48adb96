"""Suffix array by induced sorting, and its permuted common prefixes, on NumPy arrays.

For one shard inside a task. Suffixes are classed S or L; the leftmost S
suffixes (LMS) are placed by first byte and induced into order bucket by
bucket; equal LMS substrings get equal names and the shorter string of names is
sorted recursively, each step on half as much detail (pairs of names become one
name) until all are distinct; a second induction then places every suffix. Each
induction handles a whole bucket per step, so its cost is linear and vectorised.

Alphabet: 0 is the end mark, 1 a separator, ``byte + 2`` a byte. Separators are
ordered by position, so equal text goes on matching only up to the next one.
"""

from __future__ import annotations

import numpy as np

END, SEPARATOR, FIRST_BYTE = 0, 1, 2
ALPHABET = 258


def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (non-empty) pieces as one symbol string, separators between and the end mark last; where each starts."""
    joined = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = joined.astype(np.int16)
    text += FIRST_BYTE
    text[starts + lengths] = SEPARATOR
    text[-1] = END
    return text, starts


def _classes(text: np.ndarray) -> np.ndarray:
    """True for S suffixes (smaller than the next one)."""
    n = len(text)
    step = np.sign(text[1:] - text[:-1]).astype(np.int8)  # > 0: S, < 0: L, 0: as the next one
    # The class of an equal run is that of the position where it ends.
    known = np.where(step != 0, np.arange(n - 1), n)
    upto = np.minimum.accumulate(known[::-1])[::-1]
    s_type = np.empty(n, bool)
    s_type[-1] = True
    s_type[:-1] = step[np.minimum(upto, n - 2)] > 0
    return s_type


def _spread(order: np.ndarray, symbols: np.ndarray, at: np.ndarray, sa: np.ndarray, up: bool) -> None:
    """Append ``order`` to the buckets of their symbols, keeping the order within each."""
    rank = np.argsort(symbols, kind="stable")
    symbols, order = symbols[rank], order[rank]
    counts = np.bincount(symbols, minlength=ALPHABET)
    begin = np.cumsum(counts) - counts
    offset = np.arange(len(order)) - begin[symbols]
    if up:
        sa[at[symbols] + offset] = order
        at += counts
    else:
        sa[at[symbols] - offset] = order
        at -= counts


def _induce(text: np.ndarray, s_type: np.ndarray, seeds: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """The order of all suffixes, given the LMS suffixes in order within each bucket."""
    sa = np.full(len(text), -1, np.int32)
    seed_symbols = text[seeds]
    seed_ends = np.searchsorted(seed_symbols, np.arange(ALPHABET + 1))
    at = heads.copy()
    for c in range(ALPHABET):  # L suffixes, smallest bucket first
        done = heads[c]
        while done < at[c]:
            new = sa[done : at[c]]
            done = at[c]
            new = new[new > 0] - 1
            new = new[~s_type[new]]
            if len(new):
                _spread(new, text[new], at, sa, True)
        new = seeds[seed_ends[c] : seed_ends[c + 1]]
        new = new[new > 0] - 1  # the suffix before a leftmost S is L
        if len(new):
            _spread(new, text[new], at, sa, True)
    l_ends = at
    at = tails - 1
    sa[0] = len(text) - 1
    at[END] -= 1
    for c in range(ALPHABET - 1, -1, -1):  # S suffixes, largest bucket first
        done = tails[c] - 1
        while done > at[c]:
            new = sa[at[c] + 1 : done + 1][::-1]
            done = at[c]
            new = new[new > 0] - 1
            new = new[s_type[new]]
            if len(new):
                _spread(new, text[new], at, sa, False)
        new = sa[heads[c] : l_ends[c]][::-1]
        new = new[new > 0] - 1
        new = new[s_type[new]]
        if len(new):
            _spread(new, text[new], at, sa, False)
    return sa


def _words(text: np.ndarray) -> np.ndarray:
    """At every position, its four symbols as one 64-bit value (zeros beyond the end)."""
    padded = np.zeros(len(text) + 4, np.uint16)
    padded[: len(text)] = text
    return np.ndarray((len(text) + 1,), "<u8", padded.tobytes(), strides=(2,))


def _name(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """For each LMS position in text order, the rank of its substring (equal substrings: equal ranks)."""
    length = np.empty(len(text), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1].astype(np.int64), ordered[1:].astype(np.int64)
    same = (length[a] == length[b]) & (text[b] != SEPARATOR)
    live = np.flatnonzero(same)
    words, done = _words(text), 0
    while len(live):
        need = length[a[live]] - done
        x, y = words[a[live] + done], words[b[live] + done]
        short = need < 4
        keep = np.where(short, (np.uint64(1) << (np.minimum(need, 3) * 16).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        equal = ((x ^ y) & keep) == 0
        same[live[~equal]] = False
        live = live[equal & (need > 4)]
        done += 4
    names = np.empty(len(text), np.int32)
    names[ordered] = np.r_[0, np.cumsum(~same)]
    return names[lms]


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names.

    A rank is where a group of equal names begins in the order. Each step sorts
    the members of open groups by the rank that stands ``width`` further on,
    and doubles ``width``; groups of one are closed.
    """
    n = len(names)
    count = np.bincount(names)
    rank = (np.cumsum(count) - count)[names]
    live, width = np.flatnonzero(count[names] > 1), 1
    while len(live):
        ahead = live + width
        key = rank[live] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key)
        live, key = live[order], key[order]
        old = rank[live]
        at = np.arange(len(live))
        new_key = np.r_[True, key[1:] != key[:-1]]
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        rank[live] = old + np.maximum.accumulate(np.where(new_key, at, 0)) - group
        live = live[~(new_key & np.r_[new_key[1:], True])]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a symbol string that ends in the end mark."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    s_type = _classes(text)
    counts = np.bincount(text, minlength=ALPHABET)
    tails = np.cumsum(counts)
    heads = tails - counts
    lms = (np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1).astype(np.int32)
    by_symbol = lms[np.argsort(text[lms], kind="stable")]
    sa = _induce(text, s_type, by_symbol, heads, tails)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    marks = text[ordered] == SEPARATOR  # separators are ordered by position, not by what follows them
    ordered[marks] = np.sort(ordered[marks])
    names = _name(text, lms, ordered)
    return _induce(text, s_type, lms[_sorted_names(names)], heads, tails)


def permuted_lcp(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """In text order, the prefix each suffix shares with the one before it in the suffix array.

    Only irreducible values (where the symbols before the two suffixes differ)
    are compared, four symbols at a time; every other value is its left
    neighbour's less one. Separators never match.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n, dtype=np.int32)
    has = before >= 0
    left = np.where(at > 0, text[np.maximum(at - 1, 0)], -1)
    left_before = np.where(before > 0, text[np.maximum(before - 1, 0)], -2)
    start = has & ((left != left_before) | (left == SEPARATOR))
    # A match ends at the next separator or end mark of either side.
    marks = np.flatnonzero(text <= SEPARATOR).astype(np.int32)
    room = marks[np.searchsorted(marks, at)] - at
    first = np.flatnonzero(start)
    most = np.minimum(room[first], room[before[first]])
    value = np.zeros(len(first), np.int32)
    words, done = _words(text), 0
    live = np.flatnonzero(most > 0)
    while len(live):
        differ = words[first[live] + done] ^ words[before[first[live]] + done]
        equal = differ == 0
        lowest = np.maximum(differ & (~differ + np.uint64(1)), np.uint64(1))
        part = np.log2(lowest.astype(np.float64)).astype(np.int32) // 16
        value[live] = done + np.where(equal, 4, part)
        done += 4
        live = live[equal & (most[live] > done)]
    reach = np.full(n, -1, np.int32)
    reach[first] = first + np.minimum(value, most)
    return np.maximum(np.maximum.accumulate(reach) - at, 0)
