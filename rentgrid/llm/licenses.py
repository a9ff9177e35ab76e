"""License scan: Dice coefficient over word bigrams against licence templates.

A template and a candidate are sets of pairs of consecutive words, lower-cased and without
punctuation. Candidates are each line of a text, the whole text, and every window of as many
consecutive pairs as the template has, wherever it starts. Their Dice coefficient with a
template, 2 * common / (sum of sizes), must reach ``threshold``; that is possible only for
sizes within threshold / (2 - threshold) of the template's, so other templates are not
compared, and only for that share of the template's pairs in common, so windows with fewer
pairs of the template are passed over without looking at each.

Windows that match and start less than a window apart are one place (copies of a notice that
follow one another at once are one, too); its best window, the first of equals, is a match if it
lies on more than one line: what stands on one line is the line's match.

One scan of the texts, no shuffle; templates are a fixed list, sent with the task. Words
are compared by 64-bit hashes. Null and empty texts, and candidates of one word, match
nothing. A best match is the highest coefficient, ties by template name. Repeated rows
each have their result; an empty table gives no rows. All columns but the text are kept in
a struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .licence_texts import TEMPLATES
from .texts import ALNUM, mix, words

THRESHOLD = 0.8


def _pairs(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else np.zeros(0, dtype=np.uint64)


class Templates:
    def __init__(self, texts: Mapping[str, str], threshold: float):
        self.names = sorted(texts)
        column = pa.array([texts[n] for n in self.names], pa.string())
        pairs = [
            _pairs(h[a:b]) for part in words(column, ALNUM) for h in [part.hashes()]
            for a, b in zip(part.first[:-1], part.first[1:])
        ]
        self.sets, self.lengths = [np.unique(p) for p in pairs], [len(p) for p in pairs]
        self.every = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *self.sets]))
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[self.every >> np.uint64(48)] = True
        self.threshold = threshold
        self.bound = threshold / (2 - threshold)
        sizes = [len(s) for s in self.sets if len(s)]
        self.least = self.bound * min(sizes, default=np.inf)
        self.member = np.array([np.isin(self.every, own) for own in self.sets]).reshape(len(self.sets), -1)
        # pairs in common that a match needs; a template of one word has none
        self.need = np.array([np.ceil(self.bound * len(own) - 1e-9) if len(own) else np.inf for own in self.sets])

    def known(self, pairs: np.ndarray) -> np.ndarray:
        out = self.maybe[pairs >> np.uint64(48)]
        near = np.flatnonzero(out)
        if len(near):
            at = np.minimum(np.searchsorted(self.every, pairs[near]), len(self.every) - 1)
            out[near] = self.every[at] == pairs[near]
        return out

    def best(self, pairs: np.ndarray) -> list[tuple[str, float]]:
        """Templates that match a candidate, with their coefficients."""
        own = np.unique(pairs)
        out = []
        for name, other in zip(self.names, self.sets):
            if len(other) and self.bound * len(other) <= len(own) <= len(other) / self.bound:
                dice = 2 * len(np.intersect1d(own, other, assume_unique=True)) / (len(own) + len(other))
                if dice >= self.threshold:
                    out.append((name, dice))
        return out


    def windows(self, pairs: np.ndarray, at: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(first pair, pairs, template, coefficient) of the best window of each place that matches.

        ``at``: where ``pairs`` of any template stand.
        """
        member = self.member[:, np.searchsorted(self.every, pairs[at])]
        out, before = [], None
        for t in np.flatnonzero(member.sum(1) >= self.need).tolist():
            size, need = self.lengths[t], int(self.need[t])
            own = at[member[t]]
            first, last = own[: len(own) - need + 1], own[need - 1 :]
            near = last - first < size
            if len(pairs) < size or not near.any():
                continue
            mark = np.zeros(len(pairs) + 1, dtype=np.int64)
            np.add.at(mark, np.maximum(last[near] - size + 1, 0), 1)
            np.add.at(mark, np.minimum(first[near], len(pairs) - size) + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark) > 0)
            if before is None:
                before = _before(pairs)
            hit = np.zeros(len(pairs), dtype=bool)
            hit[own] = True
            dice = np.empty(len(starts))
            step = max(1, (1 << 20) // size)
            for k in range(0, len(starts), step):
                s = starts[k : k + step, None]
                span = s + np.arange(size)
                new = before[span] < s  # a pair counts where it stands first in the window
                dice[k : k + step] = 2 * (new & hit[span]).sum(1) / (new.sum(1) + len(self.sets[t]))
            good = dice >= self.threshold
            starts, dice = starts[good], dice[good]
            cuts = np.flatnonzero(np.diff(starts) >= size) + 1
            for s, d in zip(np.split(starts, cuts), np.split(dice, cuts)):
                if len(s):
                    best = int(np.argmax(d))
                    out.append((int(s[best]), size, self.names[t], float(d[best])))
        return out


def _before(pairs: np.ndarray) -> np.ndarray:
    """Where each pair stood last before, or -1."""
    order = np.argsort(pairs, kind="stable")
    same = np.flatnonzero(pairs[order[1:]] == pairs[order[:-1]])
    out = np.full(len(pairs), -1, dtype=np.int64)
    out[order[same + 1]] = order[same]
    return out


def _matches(part, templates: Templates) -> dict[int, list[tuple[int, int, str, float]]]:
    """Row -> (first and last line from 0, or -1 for the whole text; template; coefficient)."""
    h, row = part.hashes(), part.rows
    out: dict[int, list[tuple[int, int, str, float]]] = {}
    if len(h) < 2:
        return out
    breaks = np.flatnonzero(part.data == 0x0A)
    line = np.searchsorted(breaks, part.starts)
    pairs, pair_row = _pairs(h), row[1:]
    in_row = row[1:] == row[:-1]
    known = templates.known(pairs) & in_row
    in_line = in_row & (line[1:] == line[:-1])
    # lines are numbered through all rows; a line of two rows is told apart by the row
    segment = line[1:] + row[1:]
    first_line = np.searchsorted(breaks, part.offsets[:-1])
    for whole, inside, group in ((False, in_line, segment), (True, in_row, pair_row)):
        n = np.bincount(group[inside & known], minlength=1)
        for g in np.flatnonzero(n >= max(1, templates.least)).tolist():
            a, b = np.searchsorted(group, [g, g + 1])
            own = pairs[a:b][inside[a:b]]
            r = int(pair_row[a])
            for name, dice in templates.best(own):
                k = -1 if whole else int(line[a + 1] - first_line[r])
                out.setdefault(r, []).append((k, k, name, dice))
    n = np.bincount(pair_row[known], minlength=1)
    for r in np.flatnonzero(n >= templates.need.min(initial=np.inf)).tolist():
        a, b = part.first[r], part.first[r + 1] - 1
        for start, size, name, dice in templates.windows(pairs[a:b], np.flatnonzero(known[a:b])):
            k, last = (int(line[a + w] - first_line[r]) for w in (start, start + size))
            if k < last:
                out.setdefault(r, []).append((k, last, name, dice))
    return out


def licenses(
    docs: DataFrame, text: str = "text", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``row`` (struct of all other columns) and ``found``: array of (line, last_line, license, dice).

    Lines count from 0, -1 is the whole text; a window goes from ``line`` to ``last_line``.
    """
    others = [docs[c] for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).cast("string").alias("text"))
    kind = "array<struct<line: bigint, last_line: bigint, license: string, dice: double>>"
    arrow = pa.list_(pa.struct([("line", pa.int64()), ("last_line", pa.int64()), ("license", pa.string()), ("dice", pa.float64())]))
    fixed = dict(templates)

    def task(batches):
        own = Templates(fixed, threshold)
        for batch in batches:
            for part in words(batch.column(1), ALNUM):
                n = part.hi - part.lo
                found = _matches(part, own)
                values = [
                    [{"line": k, "last_line": e, "license": name, "dice": d} for k, e, name, d in sorted(found.get(r, []))]
                    for r in range(n)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.lo, n), pa.array(values, arrow)], ["row", "found"])

    return rows.mapInArrow(task, f"row {rows.schema['row'].dataType.simpleString()}, found {kind}")
