"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes some twenty figures (shares of kinds of characters, repetition of words,
word pairs and lines, lengths). Each figure is cut into bins; the model is one lookup
table per figure and per chosen pair of figures, and a score is the logistic of the sum of
table entries. Tables are learnt by cyclic boosting: in turn, each figure gets a tree of
three leaves on the current residuals, added at a small rate; then the pairs that explain
most of what is left get trees of four leaves.

The model is fitted on the driver on a bounded sample of labelled rows (``labels.SAMPLE``);
its tables are a few KB and go to the tasks with the function. Scoring is one scan of the
texts, no shuffle.

Null and empty texts have all figures 0 and are scored like any other. Without labelled
rows, or with one class only, the score is the (smoothed) share of label 1, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import labels as lb
from .texts import SPACED, Words, buffers, chunks, words

_LINES = np.ones(256, dtype=bool)
_LINES[[0x0A, 0x0D]] = False
_CLASS = np.zeros(256, dtype=np.int64)  # 0 the rest of ASCII
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[*b" \t"]] = 4
_CLASS[[*b"\r\n"]] = 5
_CLASS[[*b".,;:'\"?-()"]] = 6
_CLASS[[*b"#$%&*@^~=+_\\/<>{}[]`"]] = 7
_CLASS[ord("|")] = 8
_CLASS[ord("!")] = 9
_CLASS[128:] = 10

FIGURES = [
    "chars", "words", "word_length", "upper", "digits", "spaces", "punctuation", "symbols", "bars", "exclaims",
    "non_ascii", "others", "marked_words", "long_words", "short_words", "distinct_words", "top_word",
    "same_as_before", "distinct_pairs", "lines", "line_length", "repeated_lines",
]


def _share(part, whole):
    return part / np.maximum(whole, 1)


def _distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, and the count of the commonest."""
    n, top = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
    for r, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if b > a:
            own = np.sort(h[a:b])
            cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            n[r], top[r] = len(cut) - 1, np.diff(cut).max()
    return n, top


def figures(column: pa.Array) -> np.ndarray:
    """One row of FIGURES per text."""
    out = [np.zeros((0, len(FIGURES)))]
    raw = _raw_classes(column)
    for part, line in zip(words(column, SPACED), words(column, _LINES)):
        out.append(_figures(part, line, raw[part.lo : part.hi]))
    return np.concatenate(out)


def _raw_classes(column: pa.Array) -> np.ndarray:
    data, offsets = buffers(column)
    out = np.zeros((len(offsets) - 1, 11))
    for lo, hi in chunks(offsets):
        own = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1])) * 11
        own += _CLASS[data[offsets[lo] : offsets[hi]]]
        out[lo:hi] = np.bincount(own, minlength=(hi - lo) * 11).reshape(-1, 11)
    return out


def _figures(part: Words, line: Words, c: np.ndarray) -> np.ndarray:
    h, n = part.hashes(), np.diff(part.first).astype(float)
    length = part.ends - part.starts
    size = c.sum(1)
    total = lambda x: np.diff(np.r_[0, np.cumsum(x)][part.first])
    tail = part.data[np.maximum(part.ends - 1, 0)]
    marked = np.isin(_CLASS[tail], (7, 8, 9)) if len(tail) else np.zeros(0)
    distinct, top = _distinct(h, part.first)
    again = np.zeros(len(h))
    pair = np.zeros(len(h), dtype=np.uint64)
    if len(h):
        row = part.rows
        same_row = row[1:] == row[:-1]
        again[1:] = (h[1:] == h[:-1]) & same_row
        pair[1:] = h[1:] * np.uint64(3) + h[:-1]
    pairs, _ = _distinct(pair, part.first)
    lines = np.diff(line.first).astype(float)
    own_lines, _ = _distinct(line.hashes(), line.first)
    return np.column_stack([
        np.log1p(size), np.log1p(n), _share(total(length), n), _share(c[:, 2], size), _share(c[:, 3], size),
        _share(c[:, 4], size), _share(c[:, 6], size), _share(c[:, 7], size), _share(c[:, 8], size), _share(c[:, 9], size),
        _share(c[:, 10], size), _share(c[:, 0], size), _share(total(marked), n), _share(total(length > 14), n),
        _share(total(length < 3), n), _share(distinct, n), _share(top, n), _share(total(again), n),
        _share(pairs, n), np.log1p(lines), np.log1p(_share(size, lines)), np.where(lines > 0, 1 - _share(own_lines, lines), 0),
    ])


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray]  # inner bin edges of each figure
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)])

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.intercept)
        for k, table in enumerate(self.tables):
            out += table[bins[:, k]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[bins[:, i], bins[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


_RIDGE = 5.0


def _gain(g, h):
    return g * g / (h + _RIDGE)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best cut of a row of bins (bins before it go left) and its gain."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(a):
        return 0, 0.0
    gain = _gain(a, b) + _gain(g.sum() - a, h.sum() - b) - _gain(g.sum(), h.sum())
    k = int(np.argmax(gain))
    return k + 1, float(gain[k])


def _leaf(g, h):
    return g.sum() / (h.sum() + _RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over the bins of one figure."""
    cuts = [0, len(g)]
    for _ in range(2):
        best = max(
            ((*_split(g[a:b], h[a:b]), a) for a, b in zip(cuts, cuts[1:])), key=lambda x: x[1], default=(0, 0.0, 0)
        )
        if best[1] <= 1e-9:
            break
        cuts = sorted({*cuts, best[2] + best[0]})
    out = np.empty(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(g[a:b], h[a:b])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut of one figure, then a cut of the other on each side; the better order of both."""
    best = None
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        cut, _ = _split(a.sum(1), b.sum(1))
        out, total = np.zeros_like(a), -_gain(a.sum(), b.sum())
        for side in (slice(0, cut), slice(cut, len(a))):
            x, y = a[side].sum(0), b[side].sum(0)
            at, _ = _split(x, y)
            for half in (slice(0, at), slice(at, len(x))):
                out[side, half] = _leaf(x[half], y[half])
                total += _gain(x[half].sum(), y[half].sum())
        if best is None or total > best[1]:
            best = (out.T if turned else out, total)
    return best


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 150, rate: float = 0.15,
    pairs: int = 6, pair_bins: int = 12,
) -> Gam:
    """Cyclic boosting of the tables, main effects first."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    n = len(FIGURES)
    none = Gam(start, [np.zeros(0)] * n, [np.zeros(1)] * n, [], [])
    if len(y) == 0 or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(n)]
    model = Gam(start, edges, [np.zeros(len(e) + 1) for e in edges], [], [])
    b = model.bins(x)
    margin = np.full(len(y), start)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            m = len(table)
            step = rate * _tree(np.bincount(b[:, k], g, m), np.bincount(b[:, k], h, m))
            table += step
            margin += step[b[:, k]]
    # pairs on coarser bins: every figure's bins, grouped
    group = [np.minimum(np.arange(len(t)) * pair_bins // max(len(t), 1), pair_bins - 1) for t in model.tables]
    coarse = np.column_stack([group[k][b[:, k]] for k in range(n)])

    def sums(i, j):
        g, h = slopes()
        cell = coarse[:, i] * pair_bins + coarse[:, j]
        size = pair_bins * pair_bins
        return (np.bincount(cell, v, size).reshape(pair_bins, pair_bins) for v in (g, h))

    gains = sorted(((_pair_tree(*sums(i, j))[1], i, j) for i in range(n) for j in range(i)), reverse=True)
    chosen = [(i, j) for _, i, j in gains[:pairs]]
    small = [np.zeros((pair_bins, pair_bins)) for _ in chosen]
    for _ in range(rounds // 3):
        for (i, j), table in zip(chosen, small):
            step = rate * _pair_tree(*sums(i, j))[0]
            table += step
            margin += step[coarse[:, i], coarse[:, j]]
    model.pairs = chosen
    model.pair_tables = [t[np.ix_(group[i], group[j])] for (i, j), t in zip(chosen, small)]
    return model


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text", learn=None
) -> Gam:
    """Fit on the labelled documents whose id ``learn`` (a condition on a column) accepts."""
    rows = lambda column: [x.tobytes() for x in figures(column)]
    learn = learn or (lambda c: c.isNotNull())
    x, y = lb.sample(docs, labels, label, id, text, learn, rows)
    return fit(np.frombuffer(b"".join(x)).reshape(-1, len(FIGURES)), y)


def score(docs: DataFrame, model: Gam, text: str = "text", with_text: bool = True) -> DataFrame:
    """``row`` (all input columns as a struct) and ``score``."""
    edges, tables, intercept = model.edges, model.tables, model.intercept
    pairs, pair_tables = model.pairs, model.pair_tables

    def values(column):
        return Gam(intercept, edges, tables, pairs, pair_tables).score(figures(column))

    return lb.scored(docs, text, values, with_text)
