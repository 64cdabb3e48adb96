"""Periodic runs of words: maximal stretches that repeat with some period.

A run is a stretch of words with smallest period q and a length of at least
``max(min_words, 2 q)`` that neither neighbour extends with period q.

Short periods are scanned directly, lag by lag. A stretch of s words equal to
those q later covers one of the grams that start at every (s - g + 1)-th word, g
being the largest power of two up to s; so grams at these places are compared
with those q later, and neighbouring hits are joined and extended.

Longer periods come from minimizers at doubling scales. At scale L (a power of two) a
minimizer is a gram of L words whose hash is least in some window of L grams, all
ties included. For a run with period q from 4 L up to 8 L, the run's first window
and the one q later lie inside it and have the same content, so their minima are
equal grams q apart: an equal-minimizer pair, which seeds an extension. Equal
minimizers that follow each other within L / 2 words lie in one run of a shorter
period; they are one cluster, an arithmetic progression of places. Between
clusters each distance is tried once, so a text of one repeated word seeds no
more than a few pairs for each of its words; pairs within a cluster can only
find the shorter run again. Up to 16 clusters of one gram are within reach of
each other, so pairs are linear in the text.

Grams are compared by 64-bit hashes; runs are checked word by word at the end.
Documents are handled many at a time, joined by marks that equal nothing; a scale
keeps only those long enough to hold its periods.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches

MIN_WORDS = 12
#: Scales begin at this gram length; shorter periods (below four times it) are scanned lag by lag.
FIRST_GRAM = 16
#: Bytes of texts handled together (a longer text is handled alone).
CHUNK_BYTES = 1 << 21

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of grams of twice the length; the array gets shorter by ``length``."""
    return _mixed(h[:-length] * _MIX[2] + h[length:] * np.uint64(3) + np.uint64(length))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width`` values (a power of two)."""
    step = 1
    while step < width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x


def _extend(x: np.ndarray, a: np.ndarray, b: np.ndarray, sign: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on agree, going right (``sign`` 1, from them) or left (-1, before them).

    Rows leave the loop as soon as they meet a difference; the step doubles while they agree.
    """
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    width = 8
    while len(live):
        offset = np.arange(width) if sign > 0 else -1 - np.arange(width)
        at, to = a[live, None] + sign * out[live, None] + offset, b[live, None] + sign * out[live, None] + offset
        inside = (at >= 0) & (to >= 0) & (at < len(x)) & (to < len(x))
        same = inside & (x[np.where(inside, at, 0)] == x[np.where(inside, to, 0)])
        n = np.where(same.all(1), width, same.argmin(1))
        out[live] += n
        live = live[n == width]
        width = max(8, min(width * 2, (1 << 20) // max(1, len(live))))
    return out


def _scan_lag(x: np.ndarray, grams: dict[int, np.ndarray], q: int, min_words: int) -> np.ndarray:
    """Stretches ``(start, end, q)`` of at least ``max(q, min_words - q)`` words equal to those q later (end shifted by q)."""
    least = max(q, min_words - q)
    g = 1 << (least.bit_length() - 1)
    h, stride = grams[g], least - g + 1
    if len(h) <= q:
        return np.empty((0, 3), np.int64)
    hit = np.flatnonzero(h[: len(h) - q : stride] == h[q::stride])
    if not len(hit):
        return np.empty((0, 3), np.int64)
    first = np.r_[True, np.diff(hit) > 1]
    last = np.r_[first[1:], True]
    begin, end = hit[first] * stride, hit[last] * stride + g
    begin = begin - _extend(x, begin, begin + q, -1)
    end = end + _extend(x, end, end + q, 1)
    long = end - begin >= least
    return np.stack([begin[long], end[long] + q, np.full(long.sum(), q)], 1)


def _clusters(h: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """Minimizers of windows of ``gram`` grams, clustered: hash, first place, last place, greatest common gap."""
    least = _sliding_min(h, gram)
    # A gram is a minimizer if some window that holds it has no less: the greatest of its windows' minima.
    edge = np.zeros(gram - 1, np.uint64)
    best = ~_sliding_min(~np.concatenate([edge, least, edge]), gram)
    place = np.flatnonzero(best == h)
    place = place[np.argsort(h[place], kind="stable")]
    key = h[place]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (np.diff(place) > gram // 2)] if len(place) else np.empty(0, bool)
    at = np.flatnonzero(fresh)
    gap = np.diff(place, prepend=place[:1])
    gap[at] = 0
    step = np.gcd.reduceat(gap, at) if len(at) else gap
    last = place[np.r_[at[1:], len(place)] - 1] if len(at) else place
    return key[at], place[at], last, step


def _seeds(h: np.ndarray, gram: int) -> np.ndarray:
    """Pairs ``(place, q)`` of equal minimizers with q from 4 to 8 times ``gram``, each cluster distance once."""
    key, first, last, step = _clusters(h, gram)
    low, high = 4 * gram, 8 * gram
    out = []
    for t in range(1, len(key)):
        i = np.flatnonzero((key[:-t] == key[t:]) & (first[t:] - last[:-t] < high))
        if not len(i):
            break
        j = i + t
        # Distances from a place of cluster i to one of cluster j: first[j] - last[i], then on by the common step.
        g = np.gcd(step[i], step[j])
        one = g == 0
        g = np.where(one, 1, g)
        least, most = first[j] - last[i], np.where(one, first[j] - last[i], last[j] - first[i])
        skip = np.maximum(0, -(-(low - least) // g))
        begin = least + skip * g
        n = np.maximum(0, (np.minimum(most, high - 1) - begin) // g + 1)
        some = np.repeat(np.arange(len(i)), n)
        q = begin[some] + (np.arange(len(some)) - np.repeat(np.cumsum(n) - n, n)) * g[some]
        # The two clusters' stretches, laid over each other at this distance, share the places from here on.
        out.append(np.stack([np.maximum(first[i][some], first[j][some] - q), q], 1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _seeded(x: np.ndarray, seeds: np.ndarray, gram: int) -> np.ndarray:
    """Stretches ``(start, end, q)`` around the seeds, seeds of one stretch being extended together."""
    if not len(seeds):
        return np.empty((0, 3), np.int64)
    place, q = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))].T
    same = np.r_[False, (q[1:] == q[:-1]) & (np.diff(place) <= gram)]
    match = _equal_grams(x, place, place + q, gram)
    # A seed whose gram reaches up to the next seed of its lag is in one stretch with it.
    new = ~(same & np.r_[False, match[:-1]])
    at = np.flatnonzero(new)
    first = place[at]
    end = place[np.r_[at[1:], len(place)] - 1]
    q = q[at]
    begin = first - _extend(x, first, first + q, -1)
    end = end + _extend(x, end, end + q, 1)
    long = end - begin >= q
    return np.unique(np.stack([begin[long], end[long] + q[long], q[long]], 1), axis=0)


def _equal_grams(x: np.ndarray, a: np.ndarray, b: np.ndarray, gram: int) -> np.ndarray:
    """Whether the ``gram`` words from ``a`` and from ``b`` on agree."""
    out = np.ones(len(a), bool)
    inside = b + gram <= len(x)
    out[~inside] = False
    for begin in range(0, gram, 64):
        live = np.flatnonzero(out)
        offset = np.arange(begin, min(begin + 64, gram))
        for some in np.array_split(live, max(1, len(live) * 64 >> 20)):
            out[some] = (x[a[some, None] + offset] == x[b[some, None] + offset]).all(1)
    return out


def find_runs(x: np.ndarray, lengths: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """All runs ``(start, length, period)`` of joined texts, by start and period.

    ``x`` holds the words of all texts as whole numbers, each text followed by a
    number found nowhere else; ``lengths`` counts their words, marks left out.
    """
    found = []
    gram, h = 1, _mixed(x.astype(np.uint64) + _MIX[2])
    grams = {1: h}
    scan_below = 4 * FIRST_GRAM
    most = int(lengths.max(initial=0)) // 2
    while 2 * gram < max(min(scan_below, most + 1), min_words) and len(h) > gram:
        h, gram = _doubled(h, gram), 2 * gram
        grams[gram] = h
    for q in range(1, min(scan_below, most + 1)):
        least = max(q, min_words - q)
        if (1 << (least.bit_length() - 1)) in grams:
            found.append(_scan_lag(x, grams, q, min_words))

    # place[i] is where word i of the texts still kept stands in x.
    place, text, sizes = None, x, lengths
    gram, h = FIRST_GRAM, grams.get(FIRST_GRAM)
    del grams
    while most >= 4 * gram and h is not None:
        keep = sizes >= 8 * gram
        if not keep.all():
            mask = np.repeat(keep, sizes + 1)
            place = np.flatnonzero(mask) if place is None else place[mask]
            text, h, sizes = text[mask], h[mask[: len(h)]], sizes[keep]
        got = _seeded(text, _seeds(h, gram), gram)
        if place is not None and len(got):
            got[:, :2] += (place[got[:, 0]] - got[:, 0])[:, None]
        found.append(got)
        if len(h) <= gram:
            break
        h, gram = _doubled(h, gram), 2 * gram
    rows = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(min_words, 2 * rows[:, 2])]
    # A stretch's smallest period divides its others (they are at most half its length).
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)] if len(rows) else np.empty(0, bool)
    rows = rows[fresh]
    sure = [np.array_equal(x[a : b - q], x[a + q : b]) for a, b, q in rows.tolist()]
    rows = rows[np.array(sure, bool)] if len(rows) else rows
    rows[:, 1] -= rows[:, 0]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those in no run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def runs_of_texts(texts: list[bytes], min_words: int = MIN_WORDS) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text: its runs, and its words outside of repeated periods, joined by one space."""
    words = [t.split() for t in texts]
    ids: dict[bytes, int] = {}
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths + 1)
    x = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for w, end in zip(words, ends.tolist(), strict=True):
        x[end - 1 - len(w) : end - 1] = [ids.setdefault(v, len(ids)) for v in w]
    x[ends - 1] = len(ids) + np.arange(len(ends))
    runs = find_runs(x, lengths, min_words)
    owner = np.searchsorted(ends, runs[:, 0], "right")
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, w in enumerate(words):
        mine = runs[edges[i] : edges[i + 1]].copy()
        if len(mine):
            mine[:, 0] -= ends[i] - 1 - lengths[i]
            stay = collapsed(len(w), mine)
            w = [v for v, s in zip(w, stay.tolist(), strict=True) if s]
        yield mine, b" ".join(w)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, runs, collapsed``.

    ``runs`` lists ``(start, length, period)`` of every run by start and period,
    in words separated by ASCII white space, counted from 0. ``collapsed`` is the
    text without the words that any run holds behind its first period, the rest
    joined by one space. A null or empty text has no runs and an empty
    ``collapsed``. Rows are judged one by one, so repeated rows and rows that share
    an id, or have none, each give a row. Other columns are ignored; an empty table
    gives no rows. Texts of any length are handled whole, with memory linear in
    the text; there is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size = 0, 0
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for i, n in enumerate([*n_bytes, None]):
                if n is None or (size and size + n > CHUNK_BYTES):
                    part = batch.slice(begin, i - begin)
                    if len(part):
                        yield _judged(part, min_words)
                    begin, size = i, 0
                size += n or 0

    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    return rows.mapInArrow(
        run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def _judged(part: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    texts = [t or b"" for t in part.column(1).to_pylist()]
    counts, flat, kept = [0], [], []
    for runs, text in runs_of_texts(texts, min_words):
        counts.append(counts[-1] + len(runs))
        flat.append(runs)
        kept.append(text)
    columns = np.concatenate(flat).T if flat else np.empty((3, 0), np.int64)
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_RUN))
    listed = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [part.column(0), listed, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"]
    )
