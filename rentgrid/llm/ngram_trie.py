"""LM scoring with an Elias-Fano n-gram trie.

The model interpolates trigrams, bigrams and unigrams with absolute discounting. All
n-grams of the training texts are in the trie; nothing is pruned. The FREQUENT commonest
words have ids of their own, the others share CLASSES - FREQUENT ids by hash; such a class
is scored as one word, and the word inside it by its exact unigram share.

- **Levels.** A trigram u v w lies below its middle word v, so that one shard knows all that
  its score asks for: the words after v, the contexts u of v, and under each context its
  words. Words of a level are one monotone Elias-Fano sequence, first children another,
  probabilities and back-off weights one-byte codes on an even log scale. A trigram's word
  is kept as its rank among the successors of v: smaller numbers, and the bigram search that
  a back-off needs anyway gives that rank.
- **Shards.** A shard holds about SHARD_TOKENS training tokens: words are dealt to shards by
  id, and a word with more tokens than that has shards of its own, dealt by context. Each is
  built by one task and is one memory-mapped file. Bigrams of such a word are in all of its
  shards; there are CLASSES of them at most.
- **Counts.** Tokens go to the task that builds their shard as sorted n-grams of a batch with
  counts, packed. N-grams of words with their own shards are summed by Spark first, so that a
  frequent context reaches its shard once and not once a batch.
- **Scoring.** Tokens are sent to their shard in packed pieces, and sums for each text come
  back; a task maps one shard at a time. Shards are in GROUPS groups: a lot of texts sends its
  hashes once to each, and a text has one sum from each, however many shards there are. The
  lots of a group are dealt to SPREAD tasks. Texts are told apart by a 64-bit hash of id and text.
- **Unigrams.** Counts of frequent words (2**18 at most) and of classes (2**20) go to the
  tasks; those of all other words are joined by word, so every count is exact.

Base score: the sum over tokens of log10((c + 1) / (N + V + 1)). Words are A-Z lower-cased
and compared by 64-bit hashes. Null and empty texts are the end token alone. Repeated rows
are scored (and counted) each; a null id is told apart like empty text. With no training
text all counts are 0. An empty table gives no rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, new_folder, release_shuffles
from .texts import give_back_memory, mix, words
from .token_files import _store

FREQUENT = 1 << 18
CLASSES = 1 << 20  # ids of words; three fit in one long
SHARD_TOKENS = 1 << 21
FLUSH = 1 << 21  # tokens packed at a time
PIECE = 1 << 15  # tokens of a request
BLOCK = 1 << 16  # values packed at a time, a multiple of 64
SAMPLED = 8  # values of a sequence between two that a search begins with
GROUPS = 32  # of shards, whose sums for a text are one row
SPREAD = 8  # tasks that may share the requests to one shard
DISCOUNT = 0.5
END = np.uint64(0x7E5D_0000_0000_0E0D)  # the end token's hash


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        bits = np.zeros((((int(values[-1] >> low_bits) + n - 1 if n else 0) >> 6) + 1) << 6, dtype=bool)
        low = np.zeros((n * low_bits >> 6) + 2, dtype=np.uint64)
        for a in range(0, n, BLOCK):  # some at a time, which a cache holds; a block begins with a word
            some = values[a : a + BLOCK]
            i = np.arange(a, a + len(some))
            bits[(some >> low_bits) + i] = True
            if low_bits:
                part = (some & ((1 << low_bits) - 1)).astype(np.uint64)
                at = i * low_bits
                shift, word = (at & 63).astype(np.uint64), at >> 6
                cut = np.flatnonzero(np.diff(word, prepend=-1))
                low[word[cut]] |= np.bitwise_or.reduceat(part << shift, cut)
                over = (at & 63) + low_bits > 64  # once a word at most
                low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(n, low_bits, low, high)

    @cached_property
    def ones(self) -> np.ndarray:
        """Places of the ones in the high bits: select, worked out once for a mapped shard."""
        bits = np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little").view(bool)
        return np.flatnonzero(bits).astype(np.uint32 if len(bits) < 1 << 32 else np.int64)

    @cached_property
    def samples(self) -> np.ndarray:
        """Every SAMPLED-th value, where a search begins."""
        return self[np.arange(0, self.n, SAMPLED)]

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        i = np.asarray(i, dtype=np.int64)
        value = (self.ones[i] - i) << self.low_bits
        if self.low_bits:
            bit = i * self.low_bits
            at, shift = bit >> 6, (bit & 63).astype(np.uint64)
            # a shift by 64 is no shift, so it is done in two steps
            low = (self.low[at] >> shift) | ((self.low[at + 1] << np.uint64(1)) << (np.uint64(63) - shift))
            value |= (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """First place in [lo, hi) whose value is ``x`` or more; ``hi`` if there is none."""
        after = np.searchsorted(self.samples, x) * SAMPLED
        lo = np.minimum(np.maximum(lo, after - SAMPLED + 1), hi)
        hi = np.maximum(np.minimum(hi, after), lo)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self[mid] < x[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo


def _monotone(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ranges ``first[k]:first[k+1]``, ascending inside, made one ascending sequence."""
    ends = first[1:][np.diff(first) > 0] - 1
    base = np.zeros(len(values), dtype=np.int64)
    if len(ends) > 1:
        base[ends[:-1] + 1] = values[ends[:-1]]
    return values + np.cumsum(base, out=base)


class Level:
    """Words of nodes under their parents, with codes of probabilities."""

    def __init__(self, first: EliasFano, values: EliasFano, codes: dict[str, np.ndarray]):
        self.first, self.values, self.codes = first, values, codes

    @classmethod
    def of(cls, first: np.ndarray, values: np.ndarray, codes: dict[str, np.ndarray]) -> Level:
        return cls(EliasFano.of(first), EliasFano.of(_monotone(values, first)), codes)

    def find(self, node: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of ``x`` under ``node`` or -1, rank among the node's children)."""
        if not len(node) or not self.values.n:
            return np.full(len(node), -1, dtype=np.int64), np.full(len(node), -1, dtype=np.int64)
        new = np.diff(node, prepend=-1) != 0  # a node's range is looked up once where it repeats
        of, own = np.cumsum(new) - 1, node[new]
        lo, hi = self.first[own], self.first[own + 1]
        base = np.where(lo > 0, self.values[np.maximum(lo - 1, 0)], 0)
        lo, hi, want = lo[of], hi[of], x + base[of]
        place = self.values.successor(lo, hi, want)
        place[(place == hi) | (self.values[np.minimum(place, self.values.n - 1)] != want)] = -1
        return place, place - lo


def encode(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One byte for each log10: the nearest entry of an ascending table of 256."""
    return np.searchsorted((table[1:] + table[:-1]) / 2, values).astype(np.uint8)


# --- files -----------------------------------------------------------------------


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of arrays; those that shrink by a tenth or more are compressed."""
    fs, path = _store(path)
    head, parts, at = {}, [], 0
    for name, a in arrays.items():
        raw = a.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True)
        packed = len(small) < 0.9 * len(raw)
        parts.append(small if packed else raw)
        head[name] = (at, str(a.dtype), len(a), len(small) if packed else 0)
        at += -(-len(parts[-1]) // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    with fs.open_output_stream(path) as f:
        f.write(len(text).to_bytes(8, "little") + text)
        for part in parts:
            f.write(part + bytes(-len(part) % 8))


def _read(path: str) -> dict[str, np.ndarray]:
    """Arrays of a file, mapped where they are not compressed and the store is a local or mounted folder."""
    fs, path = _store(path)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.asarray(np.memmap(path, dtype=np.uint8, mode="r"))  # indexed faster than a memmap
    else:
        with fs.open_input_file(path) as f:
            raw = np.frombuffer(f.read_buffer(), dtype=np.uint8)
    size = int(raw[:8].view(np.int64)[0])
    head = json.loads(raw[8 : 8 + size].tobytes())
    out = {}
    for name, (at, kind, n, packed) in head.items():
        at, length = at + 8 + size, n * np.dtype(kind).itemsize
        if packed:
            small = pa.py_buffer(raw[at : at + packed])
            out[name] = np.frombuffer(pa.decompress(small, decompressed_size=length, codec="zstd"), dtype=kind)
        else:
            out[name] = raw[at : at + length].view(kind)
    return out


def _pack(level: Level, name: str) -> dict[str, np.ndarray]:
    out = {f"{name}.{c}": codes for c, codes in level.codes.items()}
    for part, ef in (("first", level.first), ("values", level.values)):
        out[f"{name}.{part}.n"] = np.array([ef.n, ef.low_bits])
        out |= {f"{name}.{part}.{k}": getattr(ef, k) for k in ("low", "high")}
    return out


def _unpack(arrays: dict[str, np.ndarray], name: str) -> Level:
    def sequence(part):
        n, low_bits = (int(x) for x in arrays[f"{name}.{part}.n"])
        return EliasFano(n, low_bits, *(arrays[f"{name}.{part}.{k}"] for k in ("low", "high")))

    codes = {c: arrays[f"{name}.{c}"] for c in ("p", "bow") if f"{name}.{c}" in arrays}
    return Level(sequence("first"), sequence("values"), codes)


# --- the model -------------------------------------------------------------------


@dataclass
class Dictionary:
    """Ids of words, their unigram shares, and the shards of n-grams."""

    hashes: np.ndarray  # frequent words, commonest first
    p1: np.ndarray  # share of each id
    shards: int  # of words that share them
    hot: np.ndarray  # ids of words with shards of their own, ascending
    first: np.ndarray  # the first of these shards, and the end
    flush: int  # tokens packed at a time
    piece: int  # tokens of a request

    def __post_init__(self):
        self.by_hash = np.argsort(self.hashes)
        self.order = self.hashes[self.by_hash]
        # a hash's leading bits tell where it stands in the list, but for a few places
        bits = len(self.order).bit_length() + 1
        self.lead = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.order >> self.lead, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def __reduce__(self):
        return Dictionary, (self.hashes, self.p1, self.shards, self.hot, self.first, self.flush, self.piece)

    def frequent(self, h: np.ndarray) -> np.ndarray:
        """Ids of frequent words, -1 for others."""
        if not len(self.order):
            return np.full(len(h), -1, dtype=np.int64)
        lead = (h >> self.lead).view(np.int64)
        at = np.minimum(self.begin[lead], len(self.order) - 1)
        found = self.order[at] == h
        out = np.where(found, self.by_hash[at], -1)
        rest = np.flatnonzero(~found)
        at, end = at[rest] + 1, self.begin[lead[rest] + 1]
        while len(rest):
            more = at < end
            rest, at, end = rest[more], at[more], end[more]
            found = self.order[at] == h[rest]
            out[rest[found]] = self.by_hash[at[found]]
            rest, at, end = rest[~found], at[~found] + 1, end[~found]
        return out

    def ids(self, h: np.ndarray) -> np.ndarray:
        found = self.frequent(h)
        rest, n = np.flatnonzero(found < 0), len(self.hashes)
        found[rest] = n + h[rest].view(np.int64) % (len(self.p1) - n)
        return found

    def keys(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Middle word, context and word of each token in one number; texts begin after an end."""
        w, v, u = _contexts(self.ids(h), first, int(self.ids(np.array([END]))[0]))
        return (v << 41) | ((u + 1) << 20) | w

    def is_hot(self, keys: np.ndarray) -> np.ndarray:
        return np.isin(keys >> 41, self.hot)

    def shard(self, keys: np.ndarray) -> np.ndarray:
        v = (keys >> 41).astype(np.int32)
        out = v % np.int32(self.shards)
        own = np.flatnonzero(np.isin(v, self.hot))
        at = np.searchsorted(self.hot, v[own])
        context = mix(((keys[own] >> 20) & 0x1FFFFF).view(np.uint64)) >> np.uint64(1)
        out[own] = self.first[at] + context.view(np.int64) % (self.first[at + 1] - self.first[at])
        return out


class Trie:
    """One shard: successors and contexts of its words, and words under each context."""

    def __init__(self, path: str):
        arrays = _read(path)
        self.roots, self.bow, self.least = arrays["roots"], arrays["bow"], float(arrays["least"][0])
        self.successors, self.contexts, self.trigrams = (_unpack(arrays, n) for n in ("s", "c", "t"))

    def gains(self, keys: np.ndarray, log1: np.ndarray) -> np.ndarray:
        """log10 of each word's share after its context over its unigram share."""
        table = _codes(self.least)
        v, u, w = keys >> 41, (keys >> 20) & 0x1FFFFF, keys & 0xFFFFF
        out = np.zeros(len(keys))
        node = np.minimum(np.searchsorted(self.roots, v), max(len(self.roots) - 1, 0))
        own = np.flatnonzero(self.roots[node] == v) if len(self.roots) else np.zeros(0, np.int64)
        node, u, w = node[own], u[own], w[own]
        place, rank = self.successors.find(node, w)
        two = np.where(place >= 0, table[self.successors.codes["p"][place]] - log1[w], self.bow[node])
        # keys that follow one another share the context
        new = np.diff((node << 21) | u, prepend=-1) != 0
        at = self.contexts.find(node[new], u[new])[0][np.cumsum(new) - 1]
        some = np.flatnonzero(at >= 0)
        two[some] += np.where(rank[some] >= 0, 0, table[self.contexts.codes["bow"][at[some]]])
        some = some[rank[some] >= 0]
        found, _ = self.trigrams.find(at[some], rank[some])
        hit = found >= 0
        two[some[hit]] = table[self.trigrams.codes["p"][found[hit]]] - log1[w[some[hit]]]
        two[some[~hit]] += table[self.contexts.codes["bow"][at[some[~hit]]]]
        out[own] = two
        return out


def _codes(least: float) -> np.ndarray:
    return np.linspace(least, 0, 256)


def _counted_pairs(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) in order, and how often."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    cut = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return row[cut], h[cut], np.diff(np.r_[cut, len(h)])


def _tokens(batch: pa.RecordBatch, at: int = 0):
    """(first row, hashes of all tokens with an end after each row, offsets of the rows)."""
    for part in words(batch.column(at)):
        n = np.diff(part.first)
        ends = np.cumsum(n + 1) - 1
        h = np.full(int(n.sum()) + len(n), END, dtype=np.uint64)
        inner = np.ones(len(h), dtype=bool)
        inner[ends] = False
        h[inner] = part.hashes()
        yield part.lo, h, np.r_[0, ends + 1]


def _sums(keys: np.ndarray) -> pa.RecordBatch:
    values, counts = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))], ["k", "c"])


def _unigrams(texts: DataFrame) -> DataFrame:
    def task(batches):
        for batch in batches:
            h = [h for _, h, _ in _tokens(batch)]
            if h:
                yield _sums(np.concatenate(h).view(np.int64))

    return texts.mapInArrow(task, "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def _most_frequent(unigrams: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of frequent words, ``most`` at most, commonest first.

    A histogram of log counts (a few thousand rows) tells from which count on.
    """
    level = F.floor(F.log2("c") * 64)
    rows = unigrams.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for bucket, n in sorted(((r.l, r.n) for r in rows), reverse=True):
        total += n
        if total > most:
            break
        least = bucket
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    table = unigrams.where(level >= least).toArrow()
    h, c = table["k"].to_numpy().view(np.uint64), table["c"].to_numpy()
    order = np.lexsort((h, -c))
    return h[order], c[order]


def _contexts(w: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's id, the one before and the one before that; texts begin after an end."""
    v = np.r_[end, w[:-1]]
    u = np.r_[-1, v[:-1]]
    v[first[:-1]] = end
    u[first[:-1]] = -1
    second = first[:-1] + 1
    u[second[second < first[1:]]] = end
    return w, v, u


def _frequent(unigrams: DataFrame, below: float, n: int) -> Dictionary:
    """Ids of words, shares of classes (CLASSES rows at most) and the plan of the shards."""
    hashes, counts = _most_frequent(unigrams, FREQUENT)
    own = len(hashes)
    rest = unigrams.join(
        unigrams.sparkSession.createDataFrame(pa.table({"k": pa.array(hashes.view(np.int64))})), "k", "left_anti"
    )
    classes = rest.groupBy(F.pmod("k", F.lit(CLASSES - own)).cast("int").alias("i")).agg(
        F.sum("c").alias("c"), F.sum(F.col("c") + 1).alias("d")
    ).toArrow()
    count, p1 = np.zeros(CLASSES, dtype=np.int64), np.ones(CLASSES)
    count[:own], p1[:own] = counts, counts + 1
    at = own + classes["i"].to_numpy()
    count[at], p1[at] = classes["c"].to_numpy(), classes["d"].to_numpy()
    hot = np.flatnonzero(count > SHARD_TOKENS)
    shards = max(1, -(-int(n - count[hot].sum()) // SHARD_TOKENS))
    first = shards + np.r_[0, np.cumsum(-(-count[hot] // SHARD_TOKENS))]
    return Dictionary(hashes, p1 / below, shards, hot, first, FLUSH, PIECE)


def _planes(sorted_: np.ndarray) -> bytes:
    """Steps of an ascending sequence."""
    return _packed(np.diff(sorted_, prepend=0).astype("<i8"))


def _unplanes(raw: pa.Buffer) -> np.ndarray:
    return np.cumsum(_unpacked(raw, "<i8"))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed, after their count."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: pa.Buffer, kind: str) -> np.ndarray:
    size, n = np.dtype(kind).itemsize, int.from_bytes(raw.slice(0, 8).to_pybytes(), "little")
    planes = pa.decompress(raw.slice(8), decompressed_size=n * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _flushes(batches, words_of: Dictionary, at: int):
    """(keys, row number in its batch, batch) of some texts' tokens at a time."""

    def joined(parts):
        out = np.concatenate(parts)
        parts.clear()  # not held while the caller works
        return out

    for batch in batches:
        held, rows, size = [], [], 0
        for lo, h, first in _tokens(batch, at):
            held.append(words_of.keys(h, first))
            rows.append(np.repeat(np.arange(lo, lo + len(first) - 1, dtype=np.int32), np.diff(first)))
            size += len(h)
            if size >= words_of.flush:
                yield joined(held), joined(rows), batch
                size = 0
        if held:
            yield joined(held), joined(rows), batch


def _by_shard(shard: np.ndarray) -> np.ndarray:
    """Places in the order of shards; small numbers are sorted by radix."""
    small = len(shard) and shard.max() < 1 << 16
    return np.argsort(shard.astype(np.uint16) if small else shard, kind="stable")


def _cuts(sorted_: np.ndarray) -> np.ndarray:
    """Where a new number begins, and the end."""
    new = np.ones(len(sorted_), dtype=bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    return np.r_[np.flatnonzero(new), len(sorted_)]


def _build(texts: DataFrame, held: Broadcast[Dictionary], n: int, folder: str) -> DataFrame:
    """Write the shards: ``shard, path``."""
    words_of = held.value
    least = float(-np.log10(max(n, 2) / DISCOUNT))  # of any discounted probability

    def pack(batches):
        own = held.value
        for keys, _, _ in _flushes(batches, own, 0):
            keys, counts = np.unique(keys[~own.is_hot(keys)], return_counts=True)
            shard = own.shard(keys)
            order = _by_shard(shard)
            keys, counts, shard = keys[order], counts[order].astype("<u4"), shard[order]
            cut = _cuts(shard)
            yield pa.RecordBatch.from_arrays([
                pa.array(shard[cut[:-1]], pa.int64()),
                pa.array([_planes(keys[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([_packed(counts[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
            ], ["shard", "keys", "counts"])

    def write(shard, k3, c3, k2, c2) -> pa.Table:
        """Sorted n-grams with counts: middle, context and word; middle and word."""
        p1 = held.value.p1
        table = _codes(least)
        w2 = (k2 & 0xFFFFF).astype(np.int32)
        first2 = _cuts(k2 >> 20)
        roots = k2[first2[:-1]] >> 20
        root = np.repeat(np.arange(len(roots), dtype=np.int32), np.diff(first2))
        total = np.bincount(root, c2, len(roots))
        bow = np.maximum(1 - np.bincount(root, c2 - DISCOUNT, len(roots)) / total, 1e-12)
        p2 = (c2 - DISCOUNT) / total[root] + bow[root] * p1[w2]
        first3 = _cuts(k3 >> 20)  # middle and context
        node = k3[first3[:-1]] >> 20
        parent = np.repeat(np.arange(len(node), dtype=np.int32), np.diff(first3))
        total3 = np.bincount(parent, c3, len(node))
        bow3 = np.maximum(1 - np.bincount(parent, c3 - DISCOUNT, len(node)) / total3, 1e-12)
        lower = np.searchsorted(k2, ((k3 >> 41) << 20) | (k3 & 0xFFFFF))
        p3 = (c3 - DISCOUNT) / total3[parent] + bow3[parent] * p2[lower]
        rank = lower - first2[root[lower]]
        code = lambda x: encode(np.log10(x), table)
        path = f"{folder}/{uuid.uuid4().hex}.trie"
        codes2, codes3, bows3 = code(p2), code(p3), code(bow3)
        del root, parent, lower, p2, p3, bow3, total3
        _write(path, {
            "roots": roots, "bow": np.log10(bow), "least": np.array([least]),
            **_pack(Level.of(first2, w2, {"p": codes2}), "s"),
            **_pack(Level.of(np.searchsorted(node >> 21, np.r_[roots, 1 << 21]), node & 0x1FFFFF, {"bow": bows3}), "c"),
            **_pack(Level.of(first3, rank, {"p": codes3}), "t"),
        })
        give_back_memory()
        return pa.table({"shard": pa.array([shard], pa.int64()), "path": [path]})

    def shared(table: pa.Table) -> pa.Table:
        # one number a token, of which a shard has a bounded number: sorted faster than with counts beside them
        tokens = np.concatenate([
            np.repeat(_unplanes(k.as_buffer()), _unpacked(c.as_buffer(), "<u4")) for k, c in zip(table["keys"], table["counts"])
        ])
        tokens.sort()
        three = _runs(tokens)
        tokens = _pair(tokens)
        tokens.sort()
        two = _runs(tokens)
        del tokens
        return write(table["shard"][0].as_py(), *three, *two)

    made = texts.mapInArrow(pack, "shard long, keys binary, counts binary")
    made = made.groupBy("shard").applyInArrow(shared, "shard long, path string")
    if not len(words_of.hot):
        return keep(made, "shards")

    def hot(batches):
        own = held.value
        for keys, _, _ in _flushes(batches, own, 0):
            yield _sums(keys[own.is_hot(keys)])

    def deal(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(held.value.shard(keys), pa.int64()), *batch.columns], ["shard", "k", "c"])

    def own_shard(table: pa.Table) -> pa.Table:
        keys, counts, pair = (table[x].to_numpy(zero_copy_only=False) for x in ("k", "c", "pair"))
        k3, k2 = _summed(keys[~pair], counts[~pair]), _summed(keys[pair], counts[pair])
        return write(table["shard"][0].as_py(), *k3, *k2)

    # below the trie's folder, and removed once the shards are written
    summed, spark = f"{folder}/frequent_ngrams", texts.sparkSession
    texts.mapInArrow(hot, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).write.parquet(summed)
    three = spark.read.schema("k long, c long").parquet(summed)
    ends = words_of.first
    spread = spark.createDataFrame(pa.table({"v": words_of.hot, "a": ends[:-1], "b": ends[1:] - 1}))
    spread = spread.select("v", F.explode(F.sequence("a", "b")).alias("shard"))
    pair = F.shiftleft(F.shiftright("k", 41), 20).bitwiseOR(F.col("k").bitwiseAND(F.lit(0xFFFFF)))
    two = three.groupBy(pair.alias("k")).agg(F.sum("c").alias("c")).withColumn("v", F.shiftright("k", 20))
    two = two.join(spread, "v").select("shard", "k", "c", F.lit(True).alias("pair"))
    three = three.mapInArrow(deal, "shard long, k long, c long").withColumn("pair", F.lit(False))
    own = three.unionByName(two).groupBy("shard").applyInArrow(own_shard, "shard long, path string")
    shards = keep(made.unionByName(own), "shards")
    store, path = _store(summed)
    store.delete_dir(path)
    return shards


def _pair(keys: np.ndarray) -> np.ndarray:
    """Middle word and word."""
    return ((keys >> 41) << 20) | (keys & 0xFFFFF)


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and how often each is there."""
    cut = _cuts(ascending)
    return ascending[cut[:-1]], np.diff(cut)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    cut = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts


def _gains(docs: DataFrame, held: Broadcast[Dictionary], shards: DataFrame) -> DataFrame:
    """``doc, tokens, gain``: sums over the tokens of all rows with this hash."""

    def ask(batches):
        own = held.value
        lot = TaskContext.get().partitionId() << 32
        for keys, row, batch in _flushes(batches, own, 0):
            lot += 1
            # the hashes of a lot's texts, once for each group of shards; requests name texts by their place
            lo, hi = int(row[0]), int(row[-1]) + 1
            doc, row = batch.column(1).slice(lo, hi - lo).to_numpy(), row - lo
            shard = own.shard(keys)
            groups = np.unique(shard % GROUPS)
            yield pa.RecordBatch.from_arrays([
                pa.array(groups, pa.int64()), pa.array(np.full(len(groups), lot)), pa.array(np.full(len(groups), -1)),
                pa.array([doc.tobytes()] * len(groups), pa.binary()), pa.array([b""] * len(groups), pa.binary()),
            ], ["group", "lot", "shard", "keys", "at"])
            order = _by_shard(shard)
            keys, row, shard = keys[order], row[order], shard[order]
            cut = _cuts(shard)
            for a, b in zip(cut, cut[1:]):  # some at a time, which a cache holds
                order = np.argsort(keys[a:b])
                keys[a:b], row[a:b] = keys[a:b][order], row[a:b][order]
            cut = np.concatenate([np.arange(a, b, own.piece) for a, b in zip(cut, cut[1:])] + [cut[-1:]])
            for lo in range(0, len(cut) - 1, 64):
                own_shard = shard[cut[:-1][lo : lo + 64]]
                out = [(_planes(keys[a:b]), _packed(row[a:b].astype("<u4"))) for a, b in zip(cut[lo : lo + 64], cut[lo + 1 : lo + 65])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own_shard % GROUPS, pa.int64()), pa.array(np.full(len(out), lot)), pa.array(own_shard, pa.int64()),
                    *(pa.array(x, pa.binary()) for x in zip(*out)),
                ], ["group", "lot", "shard", "keys", "at"])

    def answer(batches):
        log1 = np.log10(held.value.p1)
        path = trie = None
        lots = {}
        for batch in batches:
            for i in range(batch.num_rows):
                lot, shard = (batch.column(c)[i].as_py() for c in (0, 1))
                keys, at = (batch.column(c)[i].as_buffer() for c in (2, 3))
                if shard < 0:  # before all requests
                    lots[lot] = np.frombuffer(keys.to_pybytes(), np.int64)
                    continue
                keys, at, docs = _unplanes(keys), _unpacked(at, "<u4"), lots[lot]
                if batch.column(4)[i].as_py() != path:
                    path = batch.column(4)[i].as_py()
                    trie = Trie(path) if path else None
                gain = np.zeros(len(keys))
                if trie:
                    # each distinct n-gram is looked up once
                    new = np.diff(keys, prepend=-1) > 0
                    gain = trie.gains(keys[new], log1)[np.cumsum(new) - 1]
                tokens, gain = np.bincount(at), np.bincount(at, gain)
                seen = np.flatnonzero(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[seen]), pa.array(tokens[seen]), pa.array(gain[seen])], ["doc", "tokens", "gain"]
                )
        give_back_memory()

    asked = docs.select("text", "doc").mapInArrow(ask, "group long, lot long, shard long, keys binary, at binary")
    asked = asked.join(shards, "shard", "left").select("group", "lot", "shard", "keys", "at", "path")
    # all of a lot's requests to a group meet in one task, which sums them
    salt = F.pmod(F.xxhash64("lot"), F.lit(SPREAD))
    asked = asked.repartition("group", salt).sortWithinPartitions("shard").drop("group")
    sums = asked.mapInArrow(answer, "doc long, tokens long, gain double")
    return sums.groupBy("doc").agg(F.sum("tokens").alias("tokens"), F.sum("gain").alias("gain"))


def scores(docs: DataFrame, learn: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, learnt, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``learn``: which rows of ``docs`` the model is trained on.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col(text).cast("string").alias("text"), F.col(id).alias("id"), F.coalesce(learn, F.lit(False)).alias("learnt")
    )
    docs = docs.withColumn("doc", F.xxhash64("id", "text"))
    texts = docs.where("learnt").select("text")
    unigrams = keep(_unigrams(texts), "unigrams")
    n, v = unigrams.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    below = float(n + v + 1)
    held = spark.sparkContext.broadcast(_frequent(unigrams, below, n))
    folder = new_folder(spark, "trie")
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)
    shards = _build(texts, held, n, folder)
    release_shuffles(spark)
    gains = keep(_gains(docs, held, shards), "gains")
    store, path = _store(folder)
    store.delete_dir(path)  # the sums are written; nothing reads the trie again
    release_shuffles(spark)
    id_kind = docs.schema["id"].dataType.simpleString()

    def task(batches):
        own = held.value
        log1 = np.log10(own.p1)
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, h, first in _tokens(batch):
                rows = len(first) - 1
                number = own.frequent(h)
                known = number >= 0
                row = np.repeat(np.arange(rows), np.diff(first))
                base = np.where(known, log1[np.maximum(number, 0)], 0.0)
                r, rare, times = _counted_pairs(row[~known], h[~known])
                cuts = np.searchsorted(r, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, rows) for c in (1, 2, 3)),
                        pa.array(key + np.arange(rows)), pa.array(np.diff(first)),
                        pa.array(np.bincount(row[known], minlength=rows)), pa.array(np.bincount(row, base, rows)),
                        pa.ListArray.from_arrays(cuts, pa.array(rare.view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64))),
                    ],
                    ["id", "learnt", "doc", "key", "n_tokens", "known", "base", "rare", "times"],
                )
                key += rows

    local = keep(
        docs.mapInArrow(
            task, f"id {id_kind}, learnt boolean, doc long, key long, n_tokens long, known long, base double, "
            "rare array<long>, times array<long>",
        ), "scored",
    )
    found = (
        local.select("key", F.inline(F.arrays_zip("rare", "times")))
        .join(unigrams, F.col("rare") == F.col("k"), "left")
        .select("key", "times", F.coalesce("c", F.lit(0)).alias("c"))
        .groupBy("key").agg(
            F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(below))).alias("rare_base"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    none = F.lit(0)
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0))
    # rows that are alike share their sums, so each has its part of the tokens
    gain = F.coalesce(F.col("gain") * F.col("n_tokens") / F.col("tokens"), F.lit(0.0))
    return local.drop("rare", "times").join(found, "key", "left").join(gains, "doc", "left").select(
        "id", "learnt", "n_tokens", (F.col("known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        base.alias("base_score"), (base + gain).alias("score"),
    )
