import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rentgrid.llm import token_files as tf
from rentgrid.llm.queries import tokenizer_path
from rentgrid.llm.shared import BATCH_BYTES, BATCH_SETTING, small_batches

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_files_hold_every_id(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "BATCH", 4)
    manifest = tf.write_token_files(documents, PATH, 2, length=16)
    rows = sorted(
        ((r.doc_id, r.text) for r in documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0)
    )
    got = sorted(map(tuple, tf.read_documents(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in rows]
    at, left = 0, [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    for doc, start, n, crc in got:
        assert start == at
        own = next(x for (i, _), x in zip(rows, left) if x is not None and i == doc and len(x) == n and zlib.crc32(np.array(x, "<u4")) == crc)
        left[next(k for k, x in enumerate(left) if x is own)] = None
        at += n
    assert left == [None] * len(left)
    shards = sorted(manifest.collect(), key=lambda r: r.shard)
    for s in shards:
        file = tf.SequenceFile(s.path)
        assert len(file) == -(-s.n_tokens // 16)
        assert sum(int(file.mask(i).sum()) for i in range(len(file))) == s.n_tokens
        assert all(len(file.ids(i)) == 16 for i in range(len(file)))
        with pytest.raises(IndexError):
            file.ids(len(file))


def test_empty(nothing):
    manifest = tf.write_token_files(nothing, PATH, 2)
    assert manifest.count() == 0 and tf.read_documents(manifest).count() == 0


def test_pieces_give_the_texts_ids(tokenizer):
    rng = random.Random(2)
    parts = [*"abcXYZ 019 ,.'-\n\t<|>", "'s", "<|endoftext|>", "é", "é", "̸", "中", "İ", "ß", "Σ", " ", " ", "\x1c", " 's", "😀"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(4000)] + [None, ""]
    with open(PATH, encoding="utf-8") as f:
        encoder = tf.TextEncoder(f.read(), 2)
    for a in range(0, len(rows), 5):
        own = rows[a : a + 5]
        for ids, n in encoder.encode(pa.array(own, pa.string())):
            got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
            assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in own]


def test_plain_words_share_a_call(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        encoder = tf.TextEncoder(f.read(), None)
    assert encoder.comma is not None
    texts = []

    class Counting:
        def encode_batch_fast(self, part, **options):
            texts.extend(part)
            return tokenizer.encode_batch_fast(part, **options)

    encoder.tokenizer = Counting()
    rng = random.Random(4)
    words = ["".join(rng.choice("abcXYZ0189") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    words += ["don't", ",", ", ,", "a,b", "é1", "x"]
    for ids, n in encoder.encode(pa.array(words, pa.string())):
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert len(texts) <= 3 + 6


def test_words_that_come_again_outlive_a_full_cache(tokenizer, monkeypatch):
    """Frequent words stay known when the cache is emptied; no id changes, and letters need no cutting again."""
    monkeypatch.setattr(tf, "CACHED_WORDS", 60)
    monkeypatch.setattr(tf, "chunks", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    encoder, asked = tf.TextEncoder(open(PATH, encoding="utf-8").read(), 2), []
    for name in ("_together", "_each"):
        monkeypatch.setattr(encoder, name, lambda words, tokenizer=None, f=getattr(encoder, name): asked.extend(words) or f(words))
    texts = [
        "often again Caf\u00e9 x2y " + " ".join(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[j]}{'uvwxyz'[k % 6]}" for j in range(10))
        + f" \u4e2d\u6587{k}, \uff0c{k} isn't a\u00a0b e\u0301{k} \u037e!? A{k}B caf\u00e9,{k}" for k in range(40)
    ]
    ids, _ = zip(*encoder.encode(pa.array(texts)))
    for own, text in zip(ids, texts):
        assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert encoder.letters is not None and len(encoder.known) <= 120
    assert asked.count(b"often") == 1


def test_texts_reach_tasks_in_small_batches(spark, documents, monkeypatch):
    """Whole texts came 10,000 rows at a time, whatever their bytes."""
    held, keep, before = [], tf.keep, spark.conf.get(BATCH_SETTING)
    monkeypatch.setattr(tf, "keep", lambda df, label: held.append(spark.conf.get(BATCH_SETTING)) or keep(df, label))
    tf.write_token_files(documents, PATH, 2)
    assert held == [str(BATCH_BYTES)] and spark.conf.get(BATCH_SETTING) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": batch.num_rows, "size": batch.nbytes}])

    long = spark.range(4000, numPartitions=1).selectExpr("repeat('word ', 1000) as text")
    with small_batches(spark):
        rows = long.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in rows) == 4000 and max(r.size for r in rows) < 2 * BATCH_BYTES


def test_a_resting_encoder_keeps_few_words(tokenizer, monkeypatch):
    """Between tasks only frequent words stay, and the next task's ids are the same."""
    monkeypatch.setattr(tf, "KEPT_WORDS", 20)
    monkeypatch.setattr(tf, "chunks", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    encoder = tf.TextEncoder(open(PATH, encoding="utf-8").read(), 2)
    for task in range(3):
        texts = [f"often again {task} a{k}x b{k} c{k}, " + "twice " * (k % 2) for k in range(60)]
        ids, _ = zip(*encoder.encode(pa.array(texts)))
        assert [x.tolist() for x in ids] == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        encoder.rest()
        assert len(encoder.known) <= 20 and b"often" in encoder.known
        assert len(encoder.at) == len(encoder.known) and encoder.used <= len(encoder.ids)
