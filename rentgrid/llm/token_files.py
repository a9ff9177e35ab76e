"""Token ids as Arrow files of fixed-size lists, with zero-copy access to any sequence.

Documents are sorted by id over range partitions; each partition is one shard, written
by its task as two Arrow IPC files (the random-access form):

- ``<shard>.arrow``: record batches of BATCH rows of ``ids`` (``fixed_size_list[length]``)
  and ``mask`` (``fixed_size_list<bool>[length]``). Documents, each with its end id, follow
  one another through the rows; only a shard's last row is padded, with mask false.
- ``<shard>.docs.arrow``: ``doc_id``, ``start`` (in the shard) and ``n_tokens`` per document.

All batches but the last have the same number of rows, so sequence ``i`` is row
``i % BATCH`` of batch ``i // BATCH`` of a memory-mapped file: ``SequenceFile`` slices it
without a copy. Files are uncompressed for that reason; ids take two bytes where the
vocabulary fits.

A manifest (one row per shard) names the files of the attempts that counted. Files of
failed or speculative attempts have names of their own and are never read.

Null texts are empty: a document of the end id alone. Null doc ids come first, documents
of one id are ordered by text; repeated rows are all written. An empty table has an empty
manifest. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import texts
from .shared import keep, new_folder, small_batches
from .texts import _LOWER, buffers, gathered, give_back_memory

LENGTH = 1024
BATCH = 64
CACHED_WORDS = 200_000
KEPT_WORDS = 50_000  # of them between tasks
ENCODED_AT_ONCE = 1024
chunks = partial(texts.chunks, limit=1 << 20)  # bytes of texts cut at a time

# 0 white space, 1 ASCII letters and digits, 2 ASCII punctuation but the apostrophe, 3 the rest
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
for _part in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B)):
    _KIND[_part.start : _part.stop] = 1
_KIND[0x27] = 3
_NO_PUNCTUATION = re.compile(rb"[0-9A-Za-z\x80-\xff]+").fullmatch


class TextEncoder:
    """Encodes texts as the tokenizer does, each distinct piece once.

    Valid for tokenizers that lower-case, drop white space, and cut between ASCII letters
    or digits and other ASCII punctuation (``word_bpe_49k``): the ids of a text are those
    of its pieces. The apostrophe can start a contraction, so no cut is made beside it.
    Texts that spell an added token are cut at white space only, in their own case.
    """

    def __init__(self, tokenizer_json: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.end_id = end_id
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        top = max(self.tokenizer.get_vocab_size() - 1, end_id or 0)
        self.dtype = np.uint16 if top < 1 << 16 else np.uint32
        comma = self.tokenizer.encode(",", add_special_tokens=False).ids
        # an added token made of letters would be found in plain words too
        self.comma = comma[0] if len(comma) == 1 and not any(a.isalnum() for a in self.added) else None
        self.letters = self._for_letters() if self.comma is not None else None
        self.known: dict[bytes, int] = {}
        self.at, self.n = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int32)
        self.seen = np.zeros(1 << 12, dtype=np.int32)  # chunks of texts that held the piece
        self.ids, self.used = np.zeros(1 << 14, dtype=self.dtype), 0

    def _for_letters(self):
        """The same model for words of ASCII small letters, if nothing before it changes or cuts them."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        every = "abcdefghijklmnopqrstuvwxyz"
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if cut is None or normal is not None and normal.normalize_str(every) != every:
            return None
        parts = [part for part, _ in cut.pre_tokenize_str(f"{every} , {every}")]
        if [part for part in parts if part.strip()] != [every, ",", every]:
            return None
        letters = Tokenizer(self.tokenizer.model)  # shared, not copied
        letters.pre_tokenizer = WhitespaceSplit()
        return letters if letters.encode(",", add_special_tokens=False).ids == [self.comma] else None

    def _forget(self, most: int):
        """Keep the pieces that came again since the last time, the ``most`` most frequent at most."""
        k = len(self.known)
        seen = self.seen[:k]
        least = max(1, int(np.partition(seen, k - most)[k - most]))
        kept = seen > least
        self.known = {piece: i for i, piece in enumerate(p for p, keep in zip(self.known, kept.tolist()) if keep)}
        at, n = self.at[:k][kept], self.n[:k][kept]
        self.ids, self.used = gathered(self.ids, at, n.astype(np.int64)), int(n.sum())
        self.at, self.n, self.seen = np.cumsum(n) - n, n, np.zeros(len(n), dtype=np.int32)

    def _each(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words after one another, their numbers)"""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter((i for own in found for i in own), dtype=self.dtype, count=int(n.sum())), n

    def _together(self, words: list[bytes], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """The same of words without ASCII punctuation, from one text.

        A text's ids are those of its pieces; commas stand between the words, and no word
        holds one. Should the tokenizer make commas of something else, each is encoded alone.
        """
        text = b" , ".join(words).decode()
        found = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids = np.array(found, dtype=self.dtype)
        at = np.flatnonzero(ids == self.comma)
        if len(at) != len(words) - 1:
            return self._each(words)
        ends = np.r_[at, len(ids)]
        return np.delete(ids, at), np.diff(np.r_[-1, ends]) - 1

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of small ASCII letters."""
        return self._together(words, self.letters)

    def rest(self):
        """Between tasks: what the cache holds beyond KEPT_WORDS would stay in the worker's memory."""
        if len(self.known) > KEPT_WORDS:
            self._forget(KEPT_WORDS)

    @staticmethod
    def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
        """``array`` with ``values`` from ``at`` on; room grows by doubling."""
        if at + len(values) > len(array):
            array = np.concatenate([array[:at], np.zeros(max(at, len(values)) + len(values), dtype=array.dtype)])
        array[at : at + len(values)] = values
        return array

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self._forget(len(self.known) // 2)
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = [pieces[i] for i in unknown.tolist()]
            small, mixed, alone = [], [], []  # places in new
            for i, p in enumerate(new):
                if self.letters is not None and p.isalpha() and p.islower():  # of bytes: ASCII letters only
                    small.append(i)
                elif self.comma is not None and _NO_PUNCTUATION(p):
                    mixed.append(i)
                else:
                    alone.append(i)
            parts = []
            for own, encoded in ((small, self._letters), (mixed, self._together), (alone, self._each)):
                for a in range(0, len(own), ENCODED_AT_ONCE):  # what a call returns is large beside the ids
                    parts.append(encoded([new[i] for i in own[a : a + ENCODED_AT_ONCE]]))
            order = small + mixed + alone
            ids, n = (np.concatenate(x) for x in zip(*parts))
            k = len(self.known)
            numbers = np.arange(k, k + len(new))
            at[unknown[np.array(order)]] = numbers
            self.known.update(zip((new[i] for i in order), numbers.tolist()))
            self.at = self._put(self.at, k, self.used + np.cumsum(n) - n)
            self.n = self._put(self.n, k, n)
            self.seen = self._put(self.seen, k, np.zeros(len(n), dtype=np.int32))
            self.ids = self._put(self.ids, self.used, ids)
            self.used += len(ids)
        self.seen[at] += 1  # pieces are distinct
        return at

    def encode(self, column: pa.Array):
        """(ids of some rows after one another, their lengths), some rows at a time."""
        data, offsets = buffers(column)
        for lo, hi in chunks(offsets):
            raw = data[offsets[lo] : offsets[hi]]
            own = offsets[lo : hi + 1] - offsets[lo]
            kind = _KIND[raw]
            before = np.r_[np.uint8(0), kind[:-1]]
            plain = any(word in raw.tobytes() for word in self.added)
            start = (kind > 0) & (before == 0)
            if not plain:
                raw = _LOWER[raw]
                start |= (kind + before == 3) & (kind > 0) & (before > 0) & (kind < 3)
            first = own[:-1][own[:-1] < len(raw)]
            start[first] |= kind[first] > 0
            at = np.flatnonzero(start)
            solid = kind > 0
            places = np.cumsum(solid, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)
            joined = raw[solid]
            ends = np.r_[places[at] - 1, len(joined)].astype(np.int32)
            del raw, kind, before, start, solid, places
            pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(joined)])
            coded = pieces.dictionary_encode()
            del pieces, joined, ends
            number = self._numbers(coded.dictionary.to_pylist())
            number = number[coded.indices.to_numpy()] if len(at) else np.zeros(0, dtype=np.int64)
            n = self.n[number].astype(np.int64)
            upto = np.r_[0, np.cumsum(n)]
            tokens = self.ids[np.repeat(self.at[number] - upto[:-1], n) + np.arange(upto[-1])]
            row = np.searchsorted(at, own)  # first piece of each row
            lengths = upto[row[1:]] - upto[row[:-1]]
            if self.end_id is None:
                yield tokens, lengths
                continue
            lengths = lengths + 1
            ends = np.cumsum(lengths) - 1
            out = np.empty(len(tokens) + len(lengths), dtype=self.dtype)
            inner = np.ones(len(out), dtype=bool)
            inner[ends] = False
            out[ends] = self.end_id
            out[inner] = tokens
            yield out, lengths


_encoder: tuple[tuple, TextEncoder] | None = None


def encoder_of(tokenizer_json: str, end_id: int | None) -> TextEncoder:
    """This worker's encoder: its tokenizer and cache serve all tasks the worker is given."""
    global _encoder
    key = (hash(tokenizer_json), len(tokenizer_json), end_id)
    if _encoder is None or _encoder[0] != key:
        _encoder = None
        _encoder = (key, TextEncoder(tokenizer_json, end_id))
    return _encoder[1]


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Spark path: ``file:/x``, ``/x``, or any URI Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    path = path.replace("s3a://", "s3://", 1)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class _ShardWriter:
    def __init__(self, folder: str, dtype, length: int):
        self.fs, root = _store(folder)
        self.fs.create_dir(root, recursive=True)
        self.path = f"{root}/{uuid.uuid4().hex}"
        self.length, self.dtype = length, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema(
            [("ids", pa.list_(pa.field("item", kind, False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))]
        )
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = self.fs.open_output_stream(self.path + ".arrow")
        self.docs_out = self.fs.open_output_stream(self.path + ".docs.arrow")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.docs_file = pa.ipc.new_file(self.docs_out, self.docs_schema)
        self.left, self.waiting = [], 0
        self.n_docs = self.n_tokens = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray, doc_ids: pa.Array):
        starts = self.n_tokens + np.cumsum(lengths) - lengths
        self.docs_file.write_batch(
            pa.RecordBatch.from_arrays([doc_ids, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], schema=self.docs_schema)
        )
        self.n_docs += len(lengths)
        self.n_tokens += len(ids)
        self.left.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BATCH * self.length:
            self._flush(False)

    def _flush(self, last: bool):
        ids = np.concatenate(self.left) if self.left else np.zeros(0, dtype=self.dtype)
        size = BATCH * self.length
        whole = len(ids) // size * size
        for a in range(0, whole, size):
            self._batch(ids[a : a + size], size)
        ids = ids[whole:]
        if last and len(ids):
            self._batch(ids, -(-len(ids) // self.length) * self.length)
            ids = ids[:0]
        self.left, self.waiting = [ids.copy()], len(ids)

    def _batch(self, ids: np.ndarray, size: int):
        mask = np.arange(size) < len(ids)
        ids = np.r_[ids, np.zeros(size - len(ids), dtype=self.dtype)]
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=self.schema.field(k).type)
            for k, values in enumerate((ids, mask))
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self):
        self._flush(True)
        for x in (self.file, self.out, self.docs_file, self.docs_out):
            x.close()


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int | None, id: str = "doc_id", text: str = "text",
    length: int = LENGTH, folder: str | None = None,
) -> DataFrame:
    """Write all documents; the manifest: ``shard`` (from 0), ``path``, ``n_docs``, ``n_tokens``, ``start``.

    ``tokenizer``: path of the tokenizer's file on the driver (a few MB; sent to the
    tasks). ``start``: tokens of all shards before. ``folder`` is shared by all executors.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    with open(tokenizer, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # copies of one id are dealt by their text's hash too
    keys = [F.col("doc_id"), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "text")

    def task(batches):
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = encoder_of(held.value, end_id)
                writer = _ShardWriter(folder, encoder.dtype, length)
            at = 0
            for ids, lengths in encoder.encode(batch.column(1)):
                writer.add(ids, lengths, batch.column(0).slice(at, len(lengths)))
                at += len(lengths)
            give_back_memory()
        if writer is not None:
            writer.close()
            encoder.rest()
            give_back_memory()
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "path": writer.path, "n_docs": writer.n_docs, "n_tokens": writer.n_tokens}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    with small_batches(spark):
        manifest = keep(ordered.mapInArrow(task, "part int, path string, n_docs long, n_tokens long"), "shards")
    order = Window.orderBy("part")  # one row per shard
    return manifest.select(
        (F.row_number().over(order) - 1).alias("shard"), "path", "n_docs", "n_tokens",
        (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("start"),
    )


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files.

    One task per shard, a batch of sequences at a time.
    """
    shards = keep(manifest, "manifest")
    n = max(1, shards.count())
    spread = shards.repartitionByRange(n, "shard")

    def task(batches):
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist()):
                yield from _read_shard(path, base)

    return spread.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_shard(path: str, base: int):
    fs, path = _store(path)
    with fs.open_input_file(path + ".docs.arrow") as f, fs.open_input_file(path + ".arrow") as g:
        docs, file = pa.ipc.open_file(f), pa.ipc.open_file(g)
        flat, at, k = np.zeros(0, dtype=np.uint32), 0, 0  # at: the shard's token that flat begins with
        for d in range(docs.num_record_batches):
            part = docs.get_batch(d)
            sums = []
            for start, left in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                crc = 0
                while left:
                    if start >= at + len(flat):
                        at += len(flat)
                        flat = np.ascontiguousarray(file.get_batch(k).column(0).values.to_numpy(), dtype="<u4")
                        k += 1
                        continue
                    own = flat[start - at : start - at + left]
                    crc = zlib.crc32(own, crc)
                    start, left = start + len(own), left - len(own)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(part.column(1).to_numpy() + base), part.column(2), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


class SequenceFile:
    """Random access to a shard's equal-length sequences, without copies where files can be mapped."""

    def __init__(self, path: str):
        fs, path = _store(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(path + ".arrow") if local else fs.open_input_file(path + ".arrow")
        self.file = pa.ipc.open_file(self.source)
        n = self.file.num_record_batches
        self.length = self.file.schema.field("ids").type.list_size
        self.batch_rows = self.file.get_batch(0).num_rows if n else BATCH
        self.rows = (n - 1) * self.batch_rows + self.file.get_batch(n - 1).num_rows if n else 0

    def __len__(self) -> int:
        return self.rows

    def ids(self, i: int) -> np.ndarray:
        return self._values(i, 0).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> np.ndarray:
        return self._values(i, 1).to_numpy(zero_copy_only=False)  # bits become bytes

    def _values(self, i: int, column: int) -> pa.Array:
        if not 0 <= i < self.rows:
            raise IndexError(i)
        batch = self.file.get_batch(i // self.batch_rows)
        return batch.column(column).values.slice(i % self.batch_rows * self.length, self.length)
