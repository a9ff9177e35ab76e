"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal), at least
max(MIN_WORDS, MIN_POWER * q) long, that no neighbouring word extends. Runs are found per
text in O(n log^2 n) steps of whole arrays:

- **Periods below BASE** are read off directly: stretches where words p apart are equal.
- **Scales** t = BASE, 2 BASE, 4 BASE, ... find the periods from t to 2t - 1. A position is
  synchronising if, of the hashes of the t-word windows that begin at it or up to t words
  after, the least belongs to the first or the last. This depends on the 2t words from the
  position on alone, so equal contexts agree, and each t positions hold one. Two
  neighbouring synchronising positions with the same 2t words propose their distance as a
  period. In a run of period q, t <= q < 2t, the first such position returns exactly q
  later, and not before, as a stretch of q words or more recurs at multiples of q only.
- **Highly periodic regions**, windows of t words with a period of t / MIN_POWER at most,
  would make every position synchronising. They lie in runs that smaller scales have
  found, which supply their periods, and are left out.
- **Proposals** are verified on the words and extended as far as the period holds.

Texts are independent rows: nothing is shuffled, and tasks work on some texts at a time, a
long one alone (some 200 bytes a word). Words are compared exactly; hashes of windows only
propose (two of 2**63 values could hide a run if they met).

Null and empty texts have no words and no runs; the collapsed text is empty. Repeated rows
are worked on each; a null id is an id like others. An empty table gives no rows. Input
columns come back inside ``row``, so their names can clash with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import gathered, mix, words

BASE = 8
MIN_WORDS, MIN_POWER = 6, 4
_NONE = np.uint64(2**64 - 1)


def _long_enough(length: np.ndarray | int, period: np.ndarray | int):
    return length >= np.maximum(MIN_WORDS, MIN_POWER * period)


def _stretches(w: np.ndarray, p: int) -> np.ndarray:
    """(start, length, p) of the longest stretches with period ``p``, long enough ones."""
    if len(w) <= p:
        return np.zeros((0, 3), dtype=np.int64)
    edge = np.diff(np.concatenate([[0], w[p:] == w[:-p], [0]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    good = _long_enough(end - start + p, p)
    return np.stack([start[good], (end - start)[good] + p, np.full(good.sum(), p)], axis=1)


def _window_hashes(w: np.ndarray, t: int) -> np.ndarray:
    """Hash of the ``t`` (a power of two) words from each position on."""
    h = mix(w.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    size = 1
    while size < t:
        h = mix(h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:])
        size *= 2
    return h >> np.uint64(1)


def synchronising(w: np.ndarray, t: int, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of scale ``t`` and the hash of their context, the 2t words from there on.

    ``periodic``: whether the window of t words at a position is highly periodic.
    """
    ids = _window_hashes(w, t)
    ids[periodic] = _NONE
    least, size = ids, 1
    while size < t:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:-1], least[1:])  # of t + 1 windows
    n = len(least)
    at = np.flatnonzero((least != _NONE) & ((least == ids[:n]) | (least == ids[t : t + n])))
    return at, mix(ids[at]) + ids[at + t]


def _first(unequal_at, limit: int) -> int:
    """The least x < limit with ``unequal_at(lo, hi)`` true at x, else limit."""
    lo, step = 0, 64
    while lo < limit:
        hi = min(limit, lo + step)
        found = np.flatnonzero(unequal_at(lo, hi))
        if len(found):
            return lo + int(found[0])
        lo, step = hi, step * 2
    return limit


def _extended(w: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """(start, end) of the stretch with period ``d`` around the words ``i`` and ``i + d``."""
    right = _first(lambda a, b: w[i + a : i + b] != w[i + d + a : i + d + b], len(w) - d - i)
    back = w[:i][::-1], w[d : i + d][::-1]
    left = _first(lambda a, b: back[0][a:b] != back[1][a:b], i)
    return i - left, i + right + d


def runs(w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period), ordered, of texts with words ``w[first[k]:first[k+1]]``."""
    n = np.diff(first)
    # texts one after the other, each ended by a number of its own
    text = np.repeat(np.arange(len(n)), n + 1)
    row = np.full(len(text), -1, dtype=np.int64)
    inside = np.ones(len(text), dtype=bool)
    ends = np.cumsum(n + 1) - 1
    inside[ends] = False
    row[inside] = w
    row[ends] = -1 - np.arange(len(n))
    begin = ends - n
    found = [_stretches(row, p) for p in range(1, BASE) if MIN_POWER * p <= n.max(initial=0)]
    t = BASE
    while MIN_POWER * t <= n.max(initial=0):
        found.append(_scale(row, n, begin, t, np.concatenate(found)))
        t *= 2
    every = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    # a multiple of the smallest period gives the same stretch
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), dtype=bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[new]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    own = text[every[:, 0]]
    return np.column_stack([own, every[:, 0] - begin[own], every[:, 1:]])


def _scale(row: np.ndarray, n: np.ndarray, begin: np.ndarray, t: int, known: np.ndarray) -> np.ndarray:
    """Runs with periods from ``t`` to 2t - 1."""
    able = np.flatnonzero(n >= MIN_POWER * t)
    sizes = n[able] + 1
    w = gathered(row, begin[able], sizes)
    moved = np.cumsum(sizes) - sizes  # where these texts begin now
    known = known[(known[:, 1] >= t) & (known[:, 2] * MIN_POWER <= t)]
    place = np.searchsorted(begin, known[:, 0], "right") - 1
    held = np.isin(place, able)
    known, place = known[held], place[held]
    lo = known[:, 0] - begin[place] + moved[np.searchsorted(able, place)]
    change = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(change, lo, 1)
    np.add.at(change, lo + known[:, 1] - t + 1, -1)
    periodic = np.cumsum(change)[: len(w) - t + 1] > 0
    at, context = synchronising(w, t, periodic)
    order = np.argsort(context, kind="stable")
    near = (context[order][1:] == context[order][:-1])
    apart = at[order][1:] - at[order][:-1]
    near &= (apart >= t) & (apart < 2 * t)
    i, d = at[order][:-1][near], apart[near]
    order = np.lexsort((i, d))
    out, last = [], (0, 0)  # (period, end) of the stretch before
    for i, d in zip(i[order].tolist(), d[order].tolist()):
        if last[0] == d and i + d < last[1]:
            continue
        if w[i] != w[i + d]:
            continue
        start, end = _extended(w, i, d)
        last = (d, end)
        if _long_enough(end - start, d):
            out.append((start, end - start, d))
    if not out:
        return np.zeros((0, 3), dtype=np.int64)
    out = np.array(out, dtype=np.int64)
    own = np.searchsorted(moved, out[:, 0], "right") - 1
    out[:, 0] += begin[able[own]] - moved[own]
    return out


def _texts(held, dropped: np.ndarray) -> pa.Array:
    """The words that are left of each text, joined by one space."""
    keep = np.flatnonzero(~dropped)
    rows = held.rows[keep]
    sizes = held.ends[keep] - held.starts[keep] + 1
    ends = np.cumsum(sizes)
    data = gathered(held.data, held.starts[keep], sizes - 1)
    out = np.full(int(sizes.sum()), 0x20, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[ends - 1] = False
    out[inside] = data
    final = np.ones(len(keep), dtype=bool)  # no space after a text's last word
    final[:-1] = rows[1:] != rows[:-1]
    left = np.ones(len(out), dtype=bool)
    left[ends[final] - 1] = False
    size = np.bincount(rows, sizes, held.hi - held.lo).astype(np.int64)
    size -= size > 0
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(out[left]))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _work(column: pa.Array):
    """Batches ``(first row, end row, n_words, runs, collapsed)`` of a column of texts."""
    for held in words(column, lower=False):
        n = held.hi - held.lo
        found = runs(held.numbers().astype(np.int64), held.first)
        drop = np.zeros(len(held.starts) + 1, dtype=np.int64)
        base = held.first[found[:, 0]] + found[:, 1]
        np.add.at(drop, base + found[:, 3], 1)
        np.add.at(drop, base + found[:, 2], -1)
        dropped = np.cumsum(drop)[:-1] > 0
        offsets = np.searchsorted(found[:, 0], np.arange(n + 1)).astype(np.int32)
        parts = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], fields=list(_RUN))
        yield held.lo, held.hi, pa.array(np.diff(held.first)), pa.ListArray.from_arrays(pa.array(offsets), parts), _texts(
            held, dropped
        )


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (struct of all columns but the text), ``n_words``, ``runs``, ``collapsed`` of each row.

    ``runs``: array of (start, length, period) in words, by start, then period. ``collapsed``:
    the text without the words that any run holds after its first period, joined by one space.
    """
    others = [docs[c] for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), docs[text].cast("string").alias("text"))

    def task(batches):
        for batch in batches:
            for lo, hi, *found in _work(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *found], ["row", "n_words", "runs", "collapsed"]
                )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        task, f"row {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
