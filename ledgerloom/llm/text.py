"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than space, tab and the four line controls (0x20, 0x09-0x0D). Nothing here looks at
characters, so UTF-8 passes through untouched."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Words of this many bytes or more are hashed by a digest.
_LONG = 256
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_TURN, _LENGTH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


@dataclass
class Words:
    """Words of a batch of texts: ``starts``/``ends`` into ``data``; text i has words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offset of each row; a null row is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(places):
        places = np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[places[0] : places[-1]], places - places[0]


def words(column: pa.Array, lower: bool = False) -> Words:
    """All words of a column of texts; ``lower`` maps A-Z to a-z and nothing else."""
    data, places = text_bytes(column)
    if lower:
        data = _LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(places), np.int64))
    space = _SPACE[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    full = places[1:] > places[:-1]
    before[places[:-1][full]] = True
    after[places[1:][full] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, places))


def hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word from its length and its bytes, eight at a time: each step multiplies, adds and mixes, so
    that no pattern of bytes cancels out. Words of 256 bytes or more have a BLAKE2 digest. Two of n distinct words get one
    hash with a probability near n * n / 2^65 (3 * 10^-6 for ten million)."""
    size = w.ends - w.starts
    out = size.astype(np.uint64) * _LENGTH
    # the eight bytes from each place on
    data = np.concatenate([w.data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(w.data) + 1, "<u8", data, strides=(1,))
    live = np.arange(len(size))
    for at in range(0, _LONG, 8):
        live = live[size[live] > at] if at else live
        if not len(live):
            break
        chunk = eight[w.starts[live] + at] & _FIRST[np.minimum(size[live] - at, 8)]
        out[live] = mix(out[live] * _TURN + chunk)
    for i in np.flatnonzero(size >= _LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(w.data[w.starts[i] : w.ends[i]], digest_size=8).digest(), "little")
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Numbers:
    """Numbers of 64-bit keys, in the order they were first seen; two sorted arrays, 16 bytes a key."""

    def __init__(self, most: int):
        self.most, self.keys, self.values = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def full(self, keys: np.ndarray) -> bool:
        return len(self.keys) + len(keys) > self.most

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of sorted distinct keys, and the places of those that are new."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new, out = np.flatnonzero(~known), np.empty(len(keys), np.int64)
        out[known] = self.values[at[known]]
        out[new] = np.arange(len(self.keys), len(self.keys) + len(new))
        self.values = np.insert(self.values, at[new], out[new])
        self.keys = np.insert(self.keys, at[new], keys[new])
        return out, new


def room(x: np.ndarray, n: int) -> np.ndarray:
    """The array, or a longer copy of it if it has fewer than n rows."""
    if n <= len(x):
        return x
    out = np.zeros((max(n, len(x) * 3 // 2), *x.shape[1:]), x.dtype)
    out[: len(x)] = x
    return out


_kept: tuple = (None, None)


def kept(name: tuple, make: Callable[[], object]):
    """One object that a worker process keeps from task to task; asking for another one lets it go, and gives the memory that
    it and earlier work leave behind back to the machine."""
    global _kept
    if _kept[0] != name:
        _kept = (None, None)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim is not None:
            trim(0)
        _kept = (name, make())
    return _kept[1]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text each; a longer text is a part of its own."""
    _, places = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(places, places[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
