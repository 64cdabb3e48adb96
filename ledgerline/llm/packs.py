"""Packed columns: many small values of one (block, shard) pair travel as one row of byte strings."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Shard of 64-bit keys: their mixed upper bits, modulo ``n``."""
    mixed = keys.astype(np.uint64, copy=False) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(33)).astype(np.int64) % n


def pack(values: np.ndarray) -> bytes:
    """The bytes of an array, plane by plane (all first bytes, all second ones, ...): equal high bytes compress."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpack(part: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(part, np.uint8).reshape(size, -1).T.copy().view(dtype).reshape(-1)


def unpack_all(parts: Iterable[bytes], dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *(unpack(p, dtype) for p in parts)])


def split_by(shards: np.ndarray, n: int) -> Iterable[tuple[int, np.ndarray]]:
    """(shard, indexes of its entries) for every shard that has any."""
    small = shards.astype(np.int16) if n < 1 << 15 else shards  # sorted by digits
    order = np.argsort(small, kind="stable")
    ends = np.searchsorted(shards[order], np.arange(n + 1))
    for s in np.flatnonzero(np.diff(ends)):
        yield int(s), order[ends[s] : ends[s + 1]]
