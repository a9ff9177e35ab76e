"""Benchmark decontamination with an FM-index per shard of training text.

Each task cuts its documents into shards of about SHARD_WORDS words, indexes a shard,
and searches all benchmark phrases in it at once: backward search by ranks on a wavelet
matrix of the BWT, then positions by walking back to sampled suffixes. Nothing is
shuffled, and no shard is larger than its bound plus one document.

The index's alphabet is the benchmark's vocabulary. Any other word, and each end of a
document, is a separator; separators differ from each other, so suffix comparison ends
at one. Stretches between separators that are shorter than the shortest phrase cannot
hold one and are left out of the index.

Phrases are windows of ``width`` consecutive words of an item; an item of fewer words is
one phrase. The benchmark is searched in blocks of at most BLOCK_WORDS words, so what is
broadcast is bounded; each further block is one more pass over the documents.

Words are compared by 64-bit hashes. Null, empty and wordless texts have no words and are
clean. Items without an id or without words are ignored; rows of one item id are one item.
Repeated documents are searched each. An empty benchmark finds nothing; an empty table
gives no rows. All columns of the input are kept in a struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import ALNUM, words

SHARD_WORDS = 1 << 20
BLOCK_WORDS = 1 << 21
SAMPLE = 32  # every 32nd suffix position is stored
WIDTH = 10


class BitVector:
    """Bits with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(((len(bits) >> 6) + 1) * 8, dtype=np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[: len(own)] = own
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each ``i``."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Symbols with rank of any symbol in one step per bit."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1 != 0
            self.bits.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``i``."""
        lo = np.zeros_like(i)
        for k, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = (symbol >> (self.levels - 1 - k)) & 1 != 0
            a, b = bits.rank(lo), bits.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def get(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(i), dtype=np.int64)
        for bits, zeros in zip(self.bits, self.zeros):
            one = bits.get(i)
            ones = bits.rank(i)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + ones, i - ones)
        return symbol


def suffix_array(symbols: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix order by prefix doubling; each 0 is a separator that differs from all others.

    The sequence must end in a 0. Only suffixes that still tie are sorted again.
    """
    n = len(symbols)
    separator = symbols == 0
    n_separators = int(separator.sum())
    rank = symbols.astype(np.int64) + n_separators
    rank[separator] = np.arange(n_separators)
    bits = int(n_separators + sigma).bit_length()
    depth = max(1, 63 // bits)
    key = rank.copy()
    for k in range(1, depth):
        key = (key << bits) | np.r_[rank[k:], np.zeros(min(k, n), dtype=np.int64)][:n]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = start
    while not new.all():
        tied = ~new | ~np.r_[new[1:], True]
        at = np.flatnonzero(tied)
        own = sa[at]
        key = (rank[own] << 32) | rank[np.minimum(own + depth, n - 1)]
        order = np.argsort(key, kind="stable")
        sa[at] = own[order]
        key = key[order]
        new[at] = np.r_[True, key[1:] != key[:-1]]
        start[at] = np.maximum.accumulate(np.where(new[at], at, 0))
        rank[sa[at]] = start[at]
        depth *= 2
    return sa


class FMIndex:
    """Index of a sequence of symbols 1..sigma-1, cut by separators 0, ending in one."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE):
        sa = suffix_array(symbols, sigma)
        self.n = len(symbols)
        before = np.r_[symbols[-1:], symbols[:-1]]  # the symbol before each position
        self.bwt = WaveletMatrix(before[sa], sigma)
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=sigma))]
        # stretches start at a sampled position, so no walk crosses a separator
        sampled = ((sa % sample) == 0) | (before[sa] == 0)
        self.sampled = BitVector(sampled)
        self.samples = sa[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length (a row of ``phrases`` each)."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            c = phrases[alive, k]
            lo[alive] = self.smaller[c] + self.bwt.rank(c, lo[alive])
            hi[alive] = self.smaller[c] + self.bwt.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), dtype=np.int64)
        left = np.arange(len(rows))
        rows = rows.copy()
        steps = 0
        while len(left):
            found = self.sampled.get(rows)
            out[left[found]] = self.samples[self.sampled.rank(rows[found])] + steps
            left, rows = left[~found], rows[~found]
            c = self.bwt.get(rows)
            rows = self.smaller[c] + self.bwt.rank(c, rows)
            steps += 1
        return out


class Phrases:
    """Distinct phrases of a block of items, over the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.ids = sorted({item for item, _ in items})
        number = {item: k for k, item in enumerate(self.ids)}
        hashes, owner = [], []
        column = pa.array([text for _, text in items], pa.large_string())
        for part in words(column, ALNUM):
            h = part.hashes()
            for r in range(part.hi - part.lo):
                hashes.append(h[part.first[r] : part.first[r + 1]])
                owner.append(number[items[part.lo + r][0]])
        every = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.vocabulary = np.unique(every)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.vocabulary >> np.uint64(44)] = True
        pairs: dict[int, list] = {}
        for h, k in zip(hashes, owner):
            if len(h):
                m = min(width, len(h))
                symbols = np.searchsorted(self.vocabulary, h) + 1
                windows = np.lib.stride_tricks.sliding_window_view(symbols, m)
                pairs.setdefault(m, []).append(np.column_stack([windows, np.full(len(windows), k)]))
        self.by_length = {}
        for m, rows in pairs.items():
            rows = np.unique(np.concatenate(rows), axis=0)
            phrases, which = np.unique(rows[:, :m], axis=0, return_inverse=True)
            first = np.searchsorted(which, np.arange(len(phrases) + 1))  # rows are sorted by phrase
            self.by_length[m] = (phrases, first, rows[:, m])
        self.shortest = min(self.by_length, default=0)

    @property
    def sigma(self) -> int:
        return len(self.vocabulary) + 1

    def symbols(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=np.int64)
        near = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.vocabulary, h[near]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == h[near]
        out[near[same]] = at[same] + 1
        return out


def find(symbols: np.ndarray, rows: np.ndarray, phrases: Phrases) -> Iterator[tuple]:
    """Occurrences in a shard: (first word, words, item number), an array each.

    ``rows`` tells the document of each word; no phrase crosses two documents.
    """
    if not phrases.by_length or not len(symbols):
        return
    known = symbols > 0
    stretch = np.r_[True, (rows[1:] != rows[:-1]) | (known[1:] != known[:-1])]
    start = np.flatnonzero(stretch)
    length = np.diff(np.r_[start, len(symbols)])
    good = known[start] & (length >= phrases.shortest)
    if not good.any():
        return
    start, length = start[good], length[good]
    # each stretch, then a separator
    base = np.r_[0, np.cumsum(length + 1)]
    where = np.arange(base[-1]) - np.repeat(base[:-1] - start, length + 1)
    text = symbols[np.minimum(where, len(symbols) - 1)]
    text[base[1:] - 1] = 0
    index = FMIndex(text, phrases.sigma)
    for m, (wanted, first, items) in phrases.by_length.items():
        lo, hi = index.search(wanted)
        n = hi - lo
        if not n.any():
            continue
        phrase = np.repeat(np.arange(len(n)), n)
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[phrase]
        at = where[index.locate(row)]
        doc = rows[at]
        yield at, m, _items_of(doc, phrase, first, items)


def _items_of(doc, phrase, first, items):
    """Distinct (document, item number) pairs of occurrences of phrases."""
    pairs = np.unique(np.column_stack([doc, phrase]), axis=0)
    n = first[pairs[:, 1] + 1] - first[pairs[:, 1]]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[pairs[:, 1]], n)
    return np.unique(np.column_stack([np.repeat(pairs[:, 0], n), items[at]]), axis=0)


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of a bounded number of characters; one longer item is a block."""
    block, size = [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text)).where(
        F.col(item).isNotNull() & F.col(text).isNotNull()
    )
    for key, value in rows.toLocalIterator():
        if block and size + len(value) > BLOCK_WORDS * 4:
            yield block
            block, size = [], 0
        block.append((key, value))
        size += len(value)
    if block:
        yield block


def _shards(batches):
    """(batch, words of some of its rows) of about SHARD_WORDS words."""
    for batch in batches:
        for part in words(batch.column(1), ALNUM, limit=SHARD_WORDS * 4):
            yield batch.slice(part.lo, part.hi - part.lo), part


_SPANS = "array<struct<first: bigint, last: bigint>>"


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text",
    item: str = "item_id", item_text: str = "text", width: int = WIDTH, texts: bool = True,
) -> DataFrame:
    """``row`` (struct of all other columns), ``n_words``, ``n_hit``, ``spans``, ``items``, ``clean``.

    ``spans``: merged word ranges (first and last word, from 0) to remove; ``items``:
    sorted ids of the items found; ``clean``: the text without the spans, exactly as it
    was where nothing is hit (null stays null). ``texts=False`` leaves ``clean`` out.
    """
    others = [docs[c] for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    done = docs.select(
        F.struct(*others).alias("row"), F.col(text).cast("string").alias("clean"),
        F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    n = ", n_words bigint, n_hit bigint"
    kinds = {f.name: f.dataType.simpleString() for f in done.schema}
    blocks = _blocks(benchmark, item, item_text)
    block, following = next(blocks, []), next(blocks, None)
    while True:
        last = following is None
        names = [c for c in kinds if texts or not last or c != "clean"]
        schema = ", ".join(f"{c} {kinds[c]}" for c in names) + n
        held = docs.sparkSession.sparkContext.broadcast(block)

        def task(batches, held=held, last=last, names=names):
            return _search(batches, Phrases(held.value, width), last, [*names, "n_words", "n_hit"])

        done = done.select(*kinds).mapInArrow(task, schema)
        if last:
            return done
        block, following = following, next(blocks, None)


def _search(batches, phrases: Phrases, last: bool, names: list[str]):
    """Add a block's findings; after the last block the texts are cut."""
    for batch, part in _shards(batches):
        rows = part.rows
        hit = np.zeros(len(rows) + 1, dtype=np.int64)
        spans, items = batch.column(2).to_pylist(), [set(x) for x in batch.column(3).to_pylist()]
        for at, m, pairs in find(phrases.symbols(part.hashes()), rows, phrases):
            np.add.at(hit, at, 1)
            np.add.at(hit, at + m, -1)
            for r, k in pairs.tolist():
                items[r].add(phrases.ids[k])
        hit = np.cumsum(hit[:-1]) > 0
        for r, known in enumerate(spans):
            for span in known:
                hit[part.first[r] + span["first"] : part.first[r] + span["last"] + 1] = True
        total = np.r_[0, np.cumsum(hit)]
        n_hit = total[part.first[1:]] - total[part.first[:-1]]
        text = batch.column(1)
        cleaned = text.to_pylist() if last and n_hit.any() and "clean" in names else None
        for r in np.flatnonzero(n_hit).tolist():
            a, b = part.first[r], part.first[r + 1]
            ranges = np.flatnonzero(np.diff(np.r_[False, hit[a:b], False])).reshape(-1, 2)
            spans[r] = [{"first": int(x), "last": int(y) - 1} for x, y in ranges]
            if cleaned is not None:
                raw, kept, at = cleaned[r].encode(), [], 0
                for x, y in ranges:
                    kept.append(raw[at : part.starts[a + x] - part.offsets[r]])
                    at = part.ends[a + y - 1] - part.offsets[r]
                cleaned[r] = b"".join([*kept, raw[at:]]).decode()
        made = {
            "row": batch.column(0), "clean": text if cleaned is None else pa.array(cleaned, text.type),
            "spans": pa.array(spans, batch.schema.field(2).type),
            "items": pa.array([sorted(x) for x in items], batch.schema.field(3).type),
            "n_words": pa.array(np.diff(part.first), pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        }
        yield pa.RecordBatch.from_arrays([made[c] for c in names], names)
