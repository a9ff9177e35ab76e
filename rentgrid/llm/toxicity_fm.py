"""Toxicity: a factorization machine over hashed terms.

A text is the set of its words, hashed to 2**BITS slots. The model has a weight and
FACTORS numbers for each slot in use; products of the latter are the weights of pairs of
terms, so a pair that matters only together (an insult and whom it is aimed at) is learnt
too. The sum over all pairs of a text costs one pass over its terms.

It is fitted on the driver on a bounded sample of labelled rows (``labels.SAMPLE``) by
mini-batches with adaptive steps. Only terms whose presence tells something about the
label in the sample (likelihood ratio of EVIDENCE or more, LEAST texts or more) take part:
a long text has hundreds of rare terms that would otherwise be learnt by heart. So do both
terms of a pair that tells PAIR_EVIDENCE more than either alone, as when one of the two marks
the label only without the other; pairs are tried among the PAIR_TERMS terms whose presence
varies most, which bounds the work whatever the texts.
The model is broadcast; the sample bounds its terms. Scoring is one scan of the texts, no
shuffle.

Null, empty and wordless texts have no terms: they get the model's base score. Repeated
words count once. Without labelled rows, or with one class only, the score is the
(smoothed) share of label 1, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import labels as lb
from .texts import ALNUM, words

BITS = 24
FACTORS = 8
LEAST = 5
EVIDENCE = 10.0
PAIR_TERMS = 1024
PAIR_EVIDENCE = 40.0  # half a million pairs are tried: chance alone stays well below


def terms(column: pa.Array):
    """(sorted distinct slots of each text after one another, their counts), some rows at a time."""
    for part in words(column, ALNUM):
        slot = (part.hashes() >> np.uint64(64 - BITS)).astype(np.int64)
        key = np.unique((part.rows << BITS) | slot)
        n = np.bincount(key >> BITS, minlength=part.hi - part.lo)
        yield key & ((1 << BITS) - 1), n


def places(used: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``used`` of the slots that are there, and which those are."""
    if not len(used):
        return np.zeros(0, dtype=np.int64), np.zeros(len(slots), dtype=bool)
    at = np.minimum(np.searchsorted(used, slots), len(used) - 1)
    known = used[at] == slots
    return at[known], known


@dataclass
class FactorizationMachine:
    base: float
    slots: np.ndarray  # in use, sorted; the two below go by them
    weight: np.ndarray
    factors: np.ndarray

    def margin(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of texts whose slots follow one another, ``n`` each."""
        row = np.repeat(np.arange(len(n)), n)
        slots, known = places(self.slots, slots)
        row = row[known]
        out = self.base + np.bincount(row, self.weight[slots], len(n))
        for f in range(self.factors.shape[1]):
            v = self.factors[slots, f].astype(np.float64)
            out += 0.5 * (np.bincount(row, v, len(n)) ** 2 - np.bincount(row, v * v, len(n)))
        return out

    def score(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(slots, n), -30, 30)))


def _evidence(seen: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Likelihood ratio (G squared) of each term's presence against the label."""
    texts = np.array([[len(y) - y.sum()], [y.sum()]])
    terms = seen.sum(0, keepdims=True)
    out = np.zeros(seen.shape[1])
    for own, share in ((seen, terms), (texts - seen, len(y) - terms)):
        expected = texts * share / len(y)
        part = np.divide(own, expected, out=np.ones_like(own), where=(own > 0) & (expected > 0))
        out += 2 * (own * np.log(part)).sum(0)
    return out


def _evidence_of_pairs(texts: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Likelihood ratio of each two terms' four joint cases against the label.

    ``texts`` hold places of terms below ``size``.
    """
    both = [np.zeros((size, size)) for _ in (0, 1)]
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        for a in range(0, len(own), 1024):
            some = [texts[i] for i in own[a : a + 1024]]
            seen = np.zeros((len(some), size), dtype=np.float32)
            seen[np.repeat(np.arange(len(some)), [len(t) for t in some]), np.concatenate(some)] = 1
            both[label] += seen.T @ seen
    rows = [float((y == label).sum()) for label in (0, 1)]
    cases = []
    for with_both, n in zip(both, rows):
        each = np.diag(with_both)
        first, second = each[:, None] - with_both, each[None, :] - with_both
        cases.append((with_both, first, second, n - with_both - first - second))
    out = np.zeros((size, size))
    for zero, one in zip(*cases):
        for own, n in ((zero, rows[0]), (one, rows[1])):
            expected = (zero + one) * (n / len(y))
            part = np.divide(own, expected, out=np.ones_like(own), where=(own > 0) & (expected > 0))
            out += 2 * own * np.log(part)
    return out


def _paired(every: np.ndarray, seen: np.ndarray, alone: np.ndarray, texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms (of ``every``) of pairs that tell much more than either term alone."""
    n = seen.sum(0)
    varied = np.minimum(n, len(y) - n)
    tried = np.argsort(-varied, kind="stable")[:PAIR_TERMS]
    tried = np.sort(tried[varied[tried] >= LEAST])
    if len(tried) < 2:
        return every[:0]
    joint = _evidence_of_pairs([places(every[tried], t)[0] for t in texts], y, len(tried))
    more = joint - np.maximum(alone[tried][:, None], alone[tried][None, :])
    np.fill_diagonal(more, 0)
    return every[tried[(more >= PAIR_EVIDENCE).any(1)]]


def fit(
    texts: list[np.ndarray], y: np.ndarray, steps: int = 3000, batch: int = 256, rate: float = 0.2,
    ridge: float = 1e-5, seed: int = 7,
) -> FactorizationMachine:
    """Logistic loss, AdaGrad; gradients of a mini-batch are summed per slot."""
    share = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(seed)
    none = np.zeros(0, dtype=np.int64)
    model = FactorizationMachine(float(np.log(share / (1 - share))), none, none.astype(float), np.zeros((0, FACTORS)))
    if len(y) == 0 or y.min() == y.max():
        return model
    every, number = np.unique(np.concatenate([none, *texts]), return_inverse=True)
    label = np.repeat(y, [len(t) for t in texts])
    seen = np.stack([np.bincount(number[label == k], minlength=len(every)) for k in (0, 1)]).astype(float)
    alone = _evidence(seen, y)
    used = every[(seen.sum(0) >= LEAST) & (alone >= EVIDENCE)]
    used = np.union1d(used, _paired(every, seen, alone, texts, y))
    texts = [places(used, t)[0] for t in texts]
    size = len(used)
    w, v = np.zeros(size), rng.normal(0, 0.01, (size, FACTORS))
    model = FactorizationMachine(model.base, used, w, v)
    w_sum, v_sum, b_sum = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(max(1, steps * batch // len(y))):
        order = rng.permutation(len(y))
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            n = np.array([len(texts[i]) for i in own])
            slots = np.concatenate([texts[i] for i in own])
            row = np.repeat(np.arange(len(own)), n)
            uniq, at = np.unique(slots, return_inverse=True)
            uv = v[uniq]
            sums = np.zeros((len(own), FACTORS))
            squares = np.zeros(len(own))
            for f in range(FACTORS):
                x = uv[at, f]
                sums[:, f] = np.bincount(row, x, len(own))
                squares += np.bincount(row, x * x, len(own))
            margin = model.base + np.bincount(row, w[slots], len(own)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[own]) / len(own)
            e = error[row]
            g = np.bincount(at, e, len(uniq)) + ridge * w[uniq]
            w_sum[uniq] += g * g
            w[uniq] -= rate * g / np.sqrt(w_sum[uniq])
            total = np.bincount(at, e, len(uniq))
            for f in range(FACTORS):
                g = np.bincount(at, e * sums[row, f], len(uniq)) - total * uv[:, f] + ridge * uv[:, f]
                v_sum[uniq, f] += g * g
                v[uniq, f] -= 0.2 * rate * g / np.sqrt(v_sum[uniq, f])
            g = error.sum()
            b_sum += g * g
            model.base -= rate * g / np.sqrt(b_sum)
    return model


def _packed(column: pa.Array) -> list[bytes]:
    out = []
    for slots, n in terms(column):
        out += [x.astype(np.int32).tobytes() for x in np.split(slots, np.cumsum(n)[:-1])]
    return out


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", learn=None
) -> FactorizationMachine:
    """Fit on the labelled documents whose id ``learn`` (a condition on a column) accepts."""
    learn = learn or (lambda c: c.isNotNull())
    x, y = lb.sample(docs, labels, label, id, text, learn, _packed)
    return fit([np.frombuffer(t, dtype=np.int32) for t in x], y)


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text", with_text: bool = True) -> DataFrame:
    """``row`` (all input columns as a struct) and ``score``."""
    held = docs.sparkSession.sparkContext.broadcast((model.base, model.slots, model.weight, model.factors))

    def values(column):
        own = FactorizationMachine(*held.value)
        return np.concatenate([np.zeros(0), *(own.score(slots, n) for slots, n in terms(column))])

    return lb.scored(docs, text, values, with_text)
