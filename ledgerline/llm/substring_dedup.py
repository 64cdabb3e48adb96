"""Removal of repeated substrings with sharded suffix arrays.

Every ``size``-byte window picks the smallest hash of the strings of
``anchor_bytes`` bytes inside it as its anchor, so equal windows have equal
anchors wherever they stand. Neighbouring windows with one anchor form a region.
The contents of all regions are compared by name (a 64-bit hash beside that of
the anchor) in the shard of their anchor. A content that a smaller document has
is settled there: all its windows go. Where an anchor has one content only, or
one document only, no more can repeat. The other contents, each from the block of
its smallest document, go as pieces to the shard of their anchor. Pieces that
have a window's hash in common with another piece are sorted by induced suffix
sorting, and runs of permuted common prefixes of at least ``size`` bytes are the
classes of equal windows, with the smallest document id of each. Two windows that
are equal always meet in one shard, so the result is that of one suffix array over
the corpus.

Documents are dealt into blocks of about 8 MB by the hash of their id. Blocks
and shards exchange one packed row per pair, in which a block names each content
once: copies are combined before they are shuffled. Each pass over a block numbers
its contents alike, so answers name no content. An anchor with more than
``hot_rows`` contents would fill its shard; its contents are cut into single
windows that are dealt by their own names instead. Where a block already has a
crowd of contents with one anchor, these are named to shards of their own, and the
anchor's shard only learns how many they are; what it decides holds for them too.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import suffix_array as sa
from ledgerline.llm.common import BLOCK_BYTES, stage, total_bytes, with_block
from ledgerline.llm.packs import pack, shard_of, split_by, unpack, unpack_all

SIZE = 50
#: Bytes that one hash covers; windows are longer, and so are anchors from windows of twice as many on.
GRAM = 16
#: Windows of one region at most (a long periodic run is cut; any cut is exact).
RUN = 512
#: Contents of one anchor beyond which they are dealt window by window.
HOT_ROWS = 4096
#: Contents of one anchor in one block up to which they always meet in the shard of their anchor.
CROWD = 16
#: Named contents, and bytes of pieces, that a shard is expected to get.
SHARD_ANCHORS = 500_000
SHARD_BYTES = 2_500_000
#: Bytes hashed at once.
CHUNK = 1 << 20
#: A null id counts as larger than every other.
NO_ID = np.iinfo(np.int64).max
#: States of a content: a smaller document of another block has it; its block has the smallest and sends it.
SMALLER, SEND, SEND_WINDOWS = 1, 2, 3

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _gram_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes at every position."""
    at = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    head, tail = at[: len(data) - GRAM + 1], at[GRAM - 8 :]
    h = head * _C1
    h += (tail ^ (tail >> np.uint64(23))) * _C2
    h ^= h >> np.uint64(32)
    h *= _C3
    h ^= h >> np.uint64(29)
    return h


def _hashes(data: bytes, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (``GRAM`` at least) at every position."""
    grams = _gram_hashes(data)
    n = len(data) - width + 1
    h = grams[:n].copy()
    for offset in (*range(GRAM, width - GRAM, GRAM), width - GRAM) if width > GRAM else ():
        h ^= h >> np.uint64(31)
        h *= _C1
        h += grams[offset : offset + n]
    return h


def anchor_bytes(size: int) -> int:
    """Bytes of the strings that windows pick their anchor from: few repeat by chance, and a region stays short."""
    return max(GRAM, size // 2)


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if reach < width else h


def regions(texts: list[bytes], size: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of documents: their bytes, and for each region the document's index, where that document
    begins in the bytes, the region's first window in the bytes, its number of windows and its anchor."""
    group: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        if len(text) >= size:
            group.append(i)
            held += len(text)
        if group and (held >= CHUNK or i == len(texts) - 1):
            yield _chunk_regions(group, [texts[j] for j in group], size)
            group, held = [], 0
    if group:
        yield _chunk_regions(group, [texts[j] for j in group], size)


def _chunk_regions(group: list[int], texts: list[bytes], size: int):
    data = b"".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths) - lengths
    counts = lengths - size + 1  # windows of each document
    width = anchor_bytes(size)
    low = _window_min(_hashes(data, width), size - width + 1)
    edge = np.empty(len(low) + 1, bool)
    edge[0] = True
    np.not_equal(low[1:], low[:-1], out=edge[1:-1])
    edge[begins] = True
    edge[begins + counts] = True  # from here on windows would cross into the next document
    edges = np.flatnonzero(edge)
    starts, n_windows = edges[:-1], np.diff(edges)
    doc = np.searchsorted(begins, starts, "right") - 1
    inside = starts - begins[doc] < counts[doc]
    starts, n_windows, doc = starts[inside], n_windows[inside], doc[inside]
    if len(n_windows) and n_windows.max() > RUN:
        parts = -(-n_windows // RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, n_windows, doc = (np.repeat(x, parts) for x in (starts, n_windows, doc))
        starts, n_windows = starts + nth * RUN, np.minimum(n_windows - nth * RUN, RUN)
    return data, np.asarray(group)[doc], begins[doc], starts, n_windows, low[starts]


def _ids(rows: pd.DataFrame) -> np.ndarray:
    return rows["doc"].to_numpy(np.int64)


def _texts(rows: pd.DataFrame) -> list[bytes]:
    return [t or b"" for t in rows["text"]]


def _names(data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit name of the ``length`` bytes (8 at least) at each start, mixed word by word."""
    at = np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))
    last = start + length - 8
    name = length.astype(np.uint64) * _C3
    least, most = (int(length.min()), int(length.max())) if len(length) else (0, 0)
    for step in range(0, most, 8):
        live = slice(None) if step < least else np.flatnonzero(length > step)
        x = at[start + step if step + 8 <= least else np.minimum(start[live] + step, last[live])] * _C2
        x += name[live]
        x ^= x >> np.uint64(31)
        x *= _C1
        name[live] = x
    name ^= name >> np.uint64(32)
    return name


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of sorted columns change."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _order(values: np.ndarray) -> np.ndarray:
    """The order of 64-bit values (of equal ones, any): sorted with their places in the lowest bits, if that is enough."""
    place = np.uint64((1 << len(values).bit_length()) - 1)
    order = (np.sort((values & ~place) | np.arange(len(values), dtype=np.uint64)) & place).astype(np.int64)
    got = values[order]
    return order if (got[1:] >= got[:-1]).all() else np.argsort(values)


class _Contents(NamedTuple):
    """The regions of a block in the order of its rows, and the distinct contents among them.

    Contents are ordered by name and anchor, so whatever order the rows of a block come in, every pass over
    the block numbers its contents alike.
    """

    data: bytes  #: The texts of ``size`` bytes or more, one after the other.
    begins: np.ndarray  #: Where each of those begins in ``data``,
    doc_of: np.ndarray  #: and its index among the rows.
    doc: np.ndarray  #: Of each region: the index of its document,
    start: np.ndarray  #: its first window in ``data``,
    n_windows: np.ndarray
    content: np.ndarray  #: and the number of its content.
    region: np.ndarray  #: Of each content: a region that has it,
    anchor: np.ndarray
    name: np.ndarray
    low: np.ndarray  #: the smallest id of a document of the block with it,
    several: np.ndarray  #: and whether documents of two ids have it.
    crowded: np.ndarray  #: Contents that the block has too many of with one anchor,
    crowd: np.ndarray  #: and the crowd each is in.
    crowd_anchor: np.ndarray  #: Of each crowd: its anchor,
    crowd_count: np.ndarray  #: how many contents it has,
    crowd_low: np.ndarray  #: their smallest id,
    crowd_several: np.ndarray  #: and whether documents of two ids have them.

    def dealt_by(self) -> np.ndarray:
        """What the shards of the contents, then of the crowds, are dealt by: a crowded content by its name."""
        key = np.r_[self.anchor, self.crowd_anchor]
        key[self.crowded] = self.name[self.crowded]
        return key


def _crowds(anchor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contents whose anchor is that of more than ``most``, the crowd of each; anchors and sizes of the crowds."""
    slot = (anchor & np.uint64((1 << 20) - 1)).astype(np.int64)
    many = np.flatnonzero(np.bincount(slot)[slot] > most)
    values, of, count = np.unique(anchor[many], return_inverse=True, return_counts=True)
    keep = count > most
    mine = keep[of]
    return many[mine], (np.cumsum(keep) - 1)[of[mine]], values[keep], count[keep]


def _contents(rows: pd.DataFrame, size: int, crowd: int) -> _Contents | None:
    """None if no text has ``size`` bytes."""
    ids, texts = _ids(rows), _texts(rows)
    datas, parts, at = [], [], 0
    for data, doc, _, start, n_windows, anchor in regions(texts, size):
        name = _names(data, start, n_windows + (size - 1))
        parts.append((doc, start + at, n_windows, anchor, name))
        datas.append(data)
        at += len(data)
    if not parts:
        return None
    doc, start, n_windows, anchor, name = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = _order(name)
    by_name, by_anchor = name[order], anchor[order]
    if ((by_name[1:] == by_name[:-1]) & (by_anchor[1:] != by_anchor[:-1])).any():
        order = np.lexsort((anchor, name))
        by_name, by_anchor = name[order], anchor[order]
    first = _starts(by_name, by_anchor)
    content = np.empty(len(order), np.int64)
    content[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
    of = ids[doc[order]]
    low = np.minimum.reduceat(of, first)
    several = low != np.maximum.reduceat(of, first)
    region = order[first]
    crowded, in_crowd, crowd_anchor, crowd_count = _crowds(by_anchor[first], crowd)
    least, most = np.full(len(crowd_count), NO_ID), np.full(len(crowd_count), np.iinfo(np.int64).min)
    np.minimum.at(least, in_crowd, low[crowded])
    np.maximum.at(most, in_crowd, low[crowded])
    crowd_several = (least != most) | (np.bincount(in_crowd, several[crowded], len(crowd_count)) > 0)
    long_ = np.array([i for i, t in enumerate(texts) if len(t) >= size], np.int64)
    lengths = np.array([len(texts[i]) for i in long_], np.int64)
    return _Contents(
        b"".join(datas), np.cumsum(lengths) - lengths, long_, doc, start, n_windows, content,
        region, by_anchor[first], by_name[first], low, several,
        crowded, in_crowd, crowd_anchor, crowd_count, least, crowd_several,
    )


def _name_contents(size: int, crowd: int, shards: int):
    """Block -> per shard the keys and names of its contents, the smallest id of each and whether it has another.

    After the contents come crowds, each under a name of its own, with the numbers of their contents.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out, held = [], _contents(rows, size, crowd)
        if held:
            block, dealt, n = int(rows["block"].iloc[0]), held.dealt_by(), len(held.name)
            # Within a shard, the lower half of an anchor tells it from others; a mistake costs a comparison.
            key = dealt.astype(np.uint32)
            name = np.r_[held.name, held.crowd_anchor * _C2 + np.uint64(block)]
            low, several = np.r_[held.low, held.crowd_low], np.r_[held.several, held.crowd_several]
            for shard, i in split_by(shard_of(dealt, shards), shards):
                counts = held.crowd_count[i[np.searchsorted(i, n) :] - n].astype(np.uint32)
                out.append((block, shard, pack(key[i]), pack(name[i]), pack(low[i]), pack(several[i]), pack(counts)))
        return pd.DataFrame(out, columns=["block", "shard", "keys", "names", "lows", "several", "counts"])

    return run


def _compare_contents(hot_rows: int, hot_windows: int):
    """Shard -> for each block, what becomes of its contents (``SMALLER``, ``SEND``, ``SEND_WINDOWS`` or 0) in the
    order they came in, the smallest ids of the smaller ones, and about how many pieces it is to send. What becomes
    of a crowd holds for all of its contents that are not smaller elsewhere."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.array([len(k) // 4 for k in rows["keys"]], np.int64)
        key, name = unpack_all(rows["keys"], np.uint32), unpack_all(rows["names"], np.uint64)
        low, several = unpack_all(rows["lows"], np.int64), unpack_all(rows["several"], np.bool_)
        weight = np.ones(len(key), np.int64)
        for end, part in zip(np.cumsum(counts), rows["counts"], strict=True):
            weight[end - len(part) // 4 : end] = unpack(part, np.uint32)
        both = (key.astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
        order = np.argsort(both)
        both = both[order]
        if ((both[1:] == both[:-1]) & (name[order[1:]] != name[order[:-1]])).any():
            order = np.lexsort((name, key))
        at = _starts(key[order], name[order])  # where a content begins in the order
        least = np.minimum.reduceat(low[order], at)
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.repeat(least, np.diff(np.r_[at, len(order)]))
        keys = _starts(key[order])  # where a key begins
        n_contents = np.add.reduceat(weight[order[at]], np.searchsorted(at, keys))
        ids = low[order]
        two = (np.minimum.reduceat(ids, keys) != np.maximum.reduceat(ids, keys)) | np.logical_or.reduceat(several[order], keys)
        # Only other contents of the key can share windows with a content, and only those of another document count.
        asked = np.where((n_contents > 1) & two, np.where(n_contents > hot_rows, SEND_WINDOWS, SEND), 0).astype(np.uint8)
        state = np.empty(len(order), np.uint8)
        state[order] = np.repeat(asked, np.diff(np.r_[keys, len(order)]))
        state[smallest < low] = SMALLER
        out = []
        for block, shard, end, n in zip(rows["block"], rows["shard"], np.cumsum(counts), counts, strict=True):
            mine, weights = state[end - n : end], weight[end - n : end]
            if mine.any():
                lows = smallest[end - n : end][mine == SMALLER]
                n_pieces = int(weights[mine == SEND].sum()) + hot_windows * int(weights[mine == SEND_WINDOWS].sum())
                out.append((block, shard, pack(mine), pack(lows), n_pieces))
        return pd.DataFrame(out, columns=["block", "shard", "states", "lows", "n_pieces"])

    return run


def _answered(held: _Contents, answers: pd.DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """For each content of a block, its state and the smallest id of a document that has it."""
    dealt = held.dealt_by()
    state, low, sent = np.zeros(len(dealt), np.uint8), held.low.copy(), dict(split_by(shard_of(dealt, shards), shards))
    for shard, states, lows in zip(answers["shard"], answers["states"], answers["lows"], strict=True):
        i, states = sent[shard], unpack(states, np.uint8)
        if len(i) != len(states):
            raise RuntimeError("the documents changed while their repeats were looked for")
        state[i] = states
        low[i[states == SMALLER]] = unpack(lows, np.int64)
    state, of_crowd = state[: len(low)], state[len(low) :]
    state[held.crowded] = np.where(state[held.crowded] == SMALLER, SMALLER, of_crowd[held.crowd])
    return state, low


class _Pieces(NamedTuple):
    """What a block sends: its contents of state ``SEND``, then the distinct windows of those of ``SEND_WINDOWS``."""

    start: np.ndarray  #: Of each piece: where it begins in the block's data,
    length: np.ndarray
    key: np.ndarray  #: what its shard is dealt by,
    low: np.ndarray  #: and the smallest id of a document with it.
    content: np.ndarray  #: The contents sent whole; the first pieces are theirs.
    hot: np.ndarray  #: The contents sent by windows, one entry for each of their windows,
    window: np.ndarray  #: its number in the content,
    piece: np.ndarray  #: and its piece.


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts[i]`` entries: i, and its number."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _pieces(held: _Contents, state: np.ndarray, size: int) -> _Pieces:
    whole, hot = np.flatnonzero(state == SEND), np.flatnonzero(state == SEND_WINDOWS)
    n_whole, n_hot = held.n_windows[held.region[whole]], held.n_windows[held.region[hot]]
    of, window = _ragged(n_hot)
    hot = hot[of]
    at = held.start[held.region[hot]] + window
    names, first, piece = np.unique(
        _names(held.data, at, np.full(len(at), size, np.int64)), return_index=True, return_inverse=True
    )
    low = np.full(len(names), NO_ID, np.int64)
    np.minimum.at(low, piece, held.low[hot])
    return _Pieces(
        np.r_[held.start[held.region[whole]], at[first]], np.r_[n_whole + size - 1, np.full(len(names), size)],
        np.r_[held.anchor[whole], names], np.r_[held.low[whole], low], whole, hot, window, len(whole) + piece,
    )


def _send_pieces(size: int, crowd: int, shards: int, piece_shards: int):
    """Block -> per piece shard the pieces whose smallest document it has, with that document's id."""

    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        held = _contents(rows, size, crowd) if len(rows) and len(answers) else None
        if held:
            sent = _pieces(held, _answered(held, answers, shards)[0], size)
            block, data = int(rows["block"].iloc[0]), held.data
            begin, end = sent.start.tolist(), (sent.start + sent.length).tolist()
            for shard, i in split_by(shard_of(sent.key, piece_shards), piece_shards):
                body = b"".join([data[begin[j] : end[j]] for j in i.tolist()])
                out.append((block, shard, pack(sent.key[i]), pack(sent.low[i]), pack(sent.length[i].astype(np.int32)), body))
        return pd.DataFrame(out, columns=["block", "shard", "keys", "lows", "lengths", "body"])

    return run


def _share_windows(contents: list[bytes], size: int) -> np.ndarray:
    """For each piece, whether the hash of one of its windows is that of a window of another piece.

    Equal windows have equal hashes, so what is told apart here has no place in the suffix array.
    """
    data = b"".join(contents)
    n_windows = np.fromiter(map(len, contents), np.int64, len(contents)) - (size - 1)
    h = _hashes(data, size)
    owner, nth = _ragged(n_windows)
    begins = np.cumsum(n_windows + size - 1) - (n_windows + size - 1)
    h = h[begins[owner] + nth]
    order = _order(h)
    h, owner = h[order], owner[order]
    pair = np.flatnonzero((h[1:] == h[:-1]) & (owner[1:] != owner[:-1]))
    out = np.zeros(len(contents), bool)
    out[owner[pair]] = True
    out[owner[pair + 1]] = True
    return out


def smaller_windows(contents: list[bytes], low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (piece, first window, end window) of windows that also start in a piece of a smaller document.

    One suffix array over the pieces; windows are equal where neighbours in it share ``size`` symbols.
    """
    text, starts = sa.encode(contents)
    order = sa.suffix_array(text)
    shared = sa.permuted_lcp(text, order)
    lengths = np.fromiter(map(len, contents), np.int64, len(contents))
    owner = np.repeat(np.arange(len(contents)), lengths + 1)
    room = (starts + lengths)[owner] - np.arange(len(text))
    ids = np.where(room >= size, low[owner], NO_ID)
    classes = np.flatnonzero(shared[order] < size)  # where a class begins, in suffix order
    least = np.minimum.reduceat(ids[order], classes)
    smallest = np.empty(len(text), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.r_[classes, len(order)]))
    open_ = (room >= size) & (smallest < low[owner])
    edge = np.diff(np.r_[0, open_.astype(np.int8), 0])
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = owner[begin]
    return piece, begin - starts[piece], end - starts[piece]


def _judge_pieces(size: int):
    """Shard -> for each block, runs (piece, first window, end window) of windows of its pieces that also start in
    a smaller document than it named."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        index: dict[bytes, int] = {}
        asked, said, every = [], [], []
        for keys, lows, lengths, body in zip(rows["keys"], rows["lows"], rows["lengths"], rows["body"], strict=True):
            ends = np.cumsum(unpack(lengths, np.int32), dtype=np.int64).tolist()
            mine = [index.setdefault(body[a:b], len(index)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            asked.append(np.array(mine, np.int64))
            said.append(unpack(lows, np.int64))
            every.append(unpack(keys, np.uint64))
        contents, sent = list(index), np.concatenate(asked)
        key, low = np.empty(len(contents), np.uint64), np.full(len(contents), NO_ID, np.int64)
        key[sent] = np.concatenate(every)
        np.minimum.at(low, sent, np.concatenate(said))
        # A piece that is alone with its key has no other piece to share a window with.
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        some = np.flatnonzero(count[inverse] > 1)
        if len(some):
            some = some[_share_windows([contents[i] for i in some], size)]
        piece = begin = end = np.empty(0, np.int64)
        if len(some):
            piece, begin, end = smaller_windows([contents[i] for i in some], low[some], size)
            piece = some[piece]
        ends = np.searchsorted(piece, np.arange(len(contents) + 1))
        n_windows = np.fromiter(map(len, contents), np.int64, len(contents)) - (size - 1)
        out = []
        for block, mine, own in zip(rows["block"], asked, said, strict=True):
            all_ = np.flatnonzero(low[mine] < own)
            part = np.flatnonzero(low[mine] == own)
            of, nth = _ragged((ends[1:] - ends[:-1])[mine[part]])
            i = ends[mine[part]][of] + nth
            runs = np.r_[
                np.c_[all_, np.zeros(len(all_), np.int64), n_windows[mine[all_]]], np.c_[part[of], begin[i], end[i]]
            ]
            if len(runs):
                out.append((block, int(rows["shard"].iloc[0]), pack(runs.astype(np.int32))))
        return pd.DataFrame(out, columns=["block", "shard", "runs"])

    return run


def _removed(
    held: _Contents, ids: np.ndarray, flagged: pd.DataFrame, judged: pd.DataFrame, size: int, shards: int, piece_shards: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of removed bytes begin and end in the data of a block, in order."""
    state, low = _answered(held, flagged, shards)
    id_ = ids[held.doc]
    whole = low[held.content] < id_
    spans = [(held.start[whole], held.start[whole] + held.n_windows[whole])]
    # A piece was sent with the smallest id of its documents: what is left to ask is what that document loses.
    open_ = np.flatnonzero((state[held.content] >= SEND) & ~whole)
    if len(open_):
        sent = _pieces(held, state, size)
        shard = dict(split_by(shard_of(sent.key, piece_shards), piece_shards))
        found = [np.empty((0, 3), np.int64)]
        for s, r in zip(judged["shard"], judged["runs"], strict=True):
            r = unpack(r, np.int32).reshape(-1, 3).astype(np.int64)
            found.append(np.c_[shard[s][r[:, 0]], r[:, 1:]])
        runs = np.concatenate(found)
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        hot = state[held.content[open_]] == SEND_WINDOWS
        region = open_[~hot]
        piece = np.searchsorted(sent.content, held.content[region])
        first, end = np.searchsorted(runs[:, 0], piece), np.searchsorted(runs[:, 0], piece, "right")
        of, nth = _ragged(end - first)
        i, at = first[of] + nth, held.start[region[of]]
        spans.append((at + runs[i, 1], at + runs[i, 2]))
        region = open_[hot]
        first = np.searchsorted(sent.hot, held.content[region])
        of, nth = _ragged(held.n_windows[region])
        piece = sent.piece[first[of] + nth]
        smaller = np.zeros(len(sent.key), bool)
        smaller[runs[:, 0]] = True
        cut = smaller[piece] | (sent.low[piece] < id_[region[of]])
        window = (held.start[region[of]] + nth)[cut]
        spans.append((window, window + 1))
    begin, end = (np.concatenate(x) for x in zip(*spans, strict=True))
    order = np.argsort(begin)
    begin, end = begin[order], np.maximum.accumulate(end[order] + (size - 1))
    doc = np.searchsorted(held.begins, begin, "right") - 1
    new = np.flatnonzero((begin[1:] > end[:-1]) | (doc[1:] != doc[:-1])) + 1  # touching runs are one
    n = min(len(begin), 1)
    return begin[np.r_[:n, new]], end[np.r_[new - 1, len(end) - n : len(end)]]


def _cut(size: int, crowd: int, shards: int, piece_shards: int):
    """Block and its answers -> the documents without their repeated bytes."""

    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        ids, texts = _ids(rows), _texts(rows)
        spans: dict[int, list[tuple[int, int]]] = {}
        held = _contents(rows, size, crowd) if len(rows) else None
        if held:
            told = answers["states"].notna()
            begin, end = _removed(held, ids, answers[told], answers[~told], size, shards, piece_shards)
            of = np.searchsorted(held.begins, begin, "right") - 1
            at = held.begins[of]
            for doc, a, b in zip(held.doc_of[of].tolist(), (begin - at).tolist(), (end - at).tolist(), strict=True):
                spans.setdefault(doc, []).append((a, b))
        out_spans, kept = [], []
        for i, text in enumerate(texts):
            mine = spans.get(i, ())
            out_spans.append([{"start": a, "end": b} for a, b in mine])
            left = [0, *(x for span in mine for x in span), len(text)]
            kept.append(b"".join([text[a:b] for a, b in zip(left[::2], left[1::2], strict=True)]) if mine else text)
        return pd.DataFrame(
            {"doc_id": rows["doc"].where(~rows["no_id"]).astype("Int64") if len(rows) else pd.Series([], dtype="Int64"),
             "n_bytes": [len(t) for t in texts], "spans": out_spans, "kept": kept}
        )

    return run


def substring_dedup(
    docs: DataFrame, size: int = SIZE, id_column: str = "doc_id", text_column: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept``.

    Removes each byte covered by a ``size``-byte string that also starts in a
    document with a smaller id, judged on the input; matches never cross
    documents. ``spans`` are the maximal removed byte ranges ``(start, end)`` in
    order, ``kept`` the remaining bytes (a cut may fall inside a character, so
    they are binary). Null text is empty. A null id counts as larger than every
    other id, so such rows never remove bytes of others, nor of each other.
    Rows that share an id do not remove bytes of each other; each gets a row.
    Texts shorter than ``size`` bytes lose nothing. Other columns are ignored.
    An empty table gives no rows. ``size`` is at least ``GRAM`` + 1.
    """
    if size <= GRAM:
        raise ValueError(f"size must be over {GRAM} bytes")
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    n_bytes = total_bytes(rows, "text")
    n_blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    crowd = max(CROWD, hot_rows // n_blocks)
    rows = with_block(rows, "doc", n_blocks)
    rows = rows.withColumn("no_id", F.col("doc").isNull()).withColumn("doc", F.coalesce("doc", F.lit(int(NO_ID))))
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    by_block = rows.select("block", "doc", "text").groupBy("block")
    windows = (size - anchor_bytes(size)) // 2 + 1  # of a region, on average
    shards = max(1, n_bytes // windows // SHARD_ANCHORS)
    named = by_block.applyInPandas(
        _name_contents(size, crowd, shards),
        "block int, shard int, keys binary, names binary, lows binary, several binary, counts binary",
    )
    flagged = stage(
        named.groupBy("shard").applyInPandas(
            _compare_contents(hot_rows, windows), "block int, shard int, states binary, lows binary, n_pieces long"
        ),
        "repeats-flagged",
    )
    n_pieces = int(flagged.agg(F.sum("n_pieces").alias("n")).first()["n"] or 0)
    piece_shards = max(1, -(-n_pieces * (size + 18) // SHARD_BYTES))
    pieces = by_block.cogroup(flagged.groupBy("block")).applyInPandas(
        _send_pieces(size, crowd, shards, piece_shards),
        "block int, shard int, keys binary, lows binary, lengths binary, body binary",
    )
    judged = stage(
        pieces.groupBy("shard").applyInPandas(_judge_pieces(size), "block int, shard int, runs binary"), "repeats-judged"
    )
    answers = flagged.drop("n_pieces").unionByName(judged, allowMissingColumns=True)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _cut(size, crowd, shards, piece_shards),
        "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
    )
