"""Words of whole texts, straight from Arrow buffers.

Texts are cut into words over the UTF-8 bytes of a batch at once. Word characters
are given as a table over the 256 byte values; bytes above 0x7F are always word
characters, so a word never splits a code point. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_BLOCK = 1 << 15  # bytes hashed at a time


def _table(excluded: list[range]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for part in excluded:
        table[part.start : part.stop] = False
    return table


SPACED = _table([range(0x20, 0x21), range(0x09, 0x0E)])  # [^\x20\x09-\x0D]+
ALNUM = _table([range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), wrapping."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _mix_int(n: int) -> int:
    return int(mix(np.array([n & (2**64 - 1)], dtype=np.uint64))[0])


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = _mix_int(7) | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, _BLOCK + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


@cache
def _trim():
    """The C library's call that returns freed memory to the system, if it has one."""
    pa.set_memory_pool(pa.system_memory_pool())
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back_memory() -> None:
    """Return freed arrays to the system.

    Python workers stay between tasks, and what an allocator keeps would add each one's
    peak to the executor's memory.
    """
    _trim()(0)


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``data``, one after the other."""
    before = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


@dataclass
class Words:
    """Words of rows ``lo`` to ``hi`` of a batch: row ``r`` has words ``first[r-lo]:first[r-lo+1]``."""

    lo: int
    hi: int
    data: np.ndarray  # lower-cased bytes of these texts
    offsets: np.ndarray  # of the texts in ``data``
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """Row of each word, from 0."""
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        a = 0
        while a < len(out):
            base = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, base + _BLOCK, "right")))
            span = self.data[base : self.ends[b - 1]]
            total = np.zeros(len(span) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[span] * _power(_BASE, len(span)), out=total[1:])
            s, e = self.starts[a:b] - base, self.ends[a:b] - base
            out[a:b] = (total[e] - total[s]) * _power(_INVERSE, len(span) + 1)[s]
            out[a:b] += (e - s).astype(np.uint64)
            a = b
        return mix(out)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def numbers(self) -> np.ndarray:
        """A number of each word; equal words, and only those, have the same one."""
        sizes = self.ends - self.starts
        offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=offsets[1:])
        inside = gathered(self.data, self.starts, sizes)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(inside)]
        )
        return column.dictionary_encode().indices.to_numpy(zero_copy_only=False)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(
    column: pa.Array, kind: np.ndarray = SPACED, limit: int = CHUNK_BYTES, lower: bool = True
) -> Iterator[Words]:
    """Words of a string column, lower-cased (A-Z only) or as they are, some rows at a time."""
    data, offsets = buffers(column)
    for lo, hi in chunks(offsets, limit):
        own = offsets[lo : hi + 1] - offsets[lo]
        low = data[offsets[lo] : offsets[hi]]
        if lower:
            low = _LOWER[low]
        inside = np.zeros(len(low) + 2, dtype=bool)
        inside[1:-1] = kind[low]
        cut = np.zeros(len(low) + 1, dtype=bool)  # a text starts here
        cut[own[:-1]] = True
        cut[-1] = True
        here, before = inside[1:], inside[:-1]
        starts = np.flatnonzero(here & (~before | cut))
        ends = np.flatnonzero(before & (~here | cut))
        yield Words(lo, hi, low, own, starts, ends, np.searchsorted(starts, own))
    give_back_memory()
