import collections
import math
import os
import pickle
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentgrid.llm import ngram_trie as nt
from rentgrid.llm.labels import held_out
from rentgrid.llm.texts import words as word_parts

from .conftest import words

FOLDER = "/root/testdata/sf0.001"


def model(texts, id_of=lambda w: w):
    """The same model with dictionaries; ``id_of``: the id that a word shares with others."""
    c, two, three = (collections.Counter() for _ in range(3))
    for t in texts:
        s = ["begin", id_of(None), *map(id_of, t)]
        c.update(t)
        two.update(zip(s[1:], s[2:]))
        three.update(zip(s, s[1:], s[2:]))
    n, v = sum(c.values()), len(c)
    one = lambda w: (c[w] + 1) / (n + v + 1)
    share = collections.Counter()
    for w in c:
        share[id_of(w)] += one(w)
    any_ = lambda k: share[k] or 1 / (n + v + 1)
    after, after2, before2 = (collections.Counter() for _ in range(3))
    total = collections.Counter()
    for (a, _), k in two.items():
        after[a] += k - nt.DISCOUNT
        total[a] += k
    for (a, b, _), k in three.items():
        after2[a, b] += k - nt.DISCOUNT
        before2[a, b] += k

    def p2(a, w):
        return any_(w) if not total[a] else max(two[a, w] - nt.DISCOUNT, 0) / total[a] + (1 - after[a] / total[a]) * any_(w)

    def p3(a, b, w):
        k = before2[a, b]
        return p2(b, w) if not k else max(three[a, b, w] - nt.DISCOUNT, 0) / k + (1 - after2[a, b] / k) * p2(b, w)

    def score(t):
        out, a, b = 0.0, "begin", id_of(None)
        for w in t:
            k = id_of(w)
            out += math.log10(p3(a, b, k) / any_(k) * one(w))
            a, b = b, k
        return out

    return c, n, v, one, score


def check(df, texts, learn, tolerance):
    c, n, v, one, score = model([t for t, own in zip(texts, learn) if own])
    got = sorted(df.collect(), key=lambda r: r.id)
    for r, t, own in zip(got, texts, learn):
        assert (r.learnt, r.n_tokens, r.n_known, r.train_tokens) == (own, len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10(one(w)) for w in t), rel=1e-9)
        assert r.score == pytest.approx(score(t), abs=tolerance * len(t))


def test_against_dictionaries(spark, monkeypatch):
    """As shipped, then with shards of few tokens (many are of one word's own), small flushes and pieces."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 5 = 1 and n_chars < 3000")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    texts = [[*words(t), None] for _, t in rows]
    learn = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    out = held_out(F.col("doc_id"), 7, 2)
    check(nt.scores(docs, ~out), texts, learn, 0.03)
    for name, value in (("SHARD_TOKENS", 300), ("FLUSH", 1000), ("PIECE", 64)):
        monkeypatch.setattr(nt, name, value)
    check(nt.scores(docs, ~out), texts, learn, 0.03)


def test_classes(spark, monkeypatch):
    """Words past the frequent ones share ids; counts stay exact, and shares sum to one."""
    monkeypatch.setattr(nt, "FREQUENT", 3)
    monkeypatch.setattr(nt, "CLASSES", 7)
    monkeypatch.setattr(nt, "SHARD_TOKENS", 8)
    known = ["a b c d", "a c e", "b b a f g", "c a d d h", "a b"]
    vocabulary = sorted({w for t in known for w in t.split()})
    asked = [f"a {w}" for w in [*vocabulary, "unseen"]] + ["a"]
    rows = [(i, t) for i, t in enumerate(known + asked)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.id: r for r in nt.scores(df, F.col("doc_id") < len(known)).collect()}
    texts = [[*words(t), None] for _, t in rows]
    learnt = df.where(F.col("doc_id") < len(known)).select("text")
    n = sum(map(len, texts[: len(known)]))
    ids = nt._frequent(nt._unigrams(learnt), 1.0, n)
    numbers = {None: int(ids.ids(np.array([nt.END]))[0])}
    for part in word_parts(pa.array([" ".join([*vocabulary, "unseen"])])):
        numbers |= {part.word(i).decode(): int(k) for i, k in enumerate(ids.ids(part.hashes()))}
    assert len(set(numbers.values())) < len(numbers)
    c, n, v, one, score = model(texts[: len(known)], numbers.get)
    for i, t in enumerate(texts):
        assert got[i].n_known == sum(c[w] > 0 for w in t) and got[i].train_tokens == n
        assert got[i].base_score == pytest.approx(sum(math.log10(one(w)) for w in t), rel=1e-9)
        assert got[i].score == pytest.approx(score(t), abs=0.03 * len(t))


def test_repeated_rows_share_their_sums(spark):
    rows = [(1, "to be or not to be")] * 3 + [(2, "to be or not to be"), (2, "not to be"), (None, "to be")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = [[*words(t), None] for _, t in sorted(rows, key=repr)]
    got = sorted(nt.scores(df, F.lit(True)).collect(), key=lambda r: (str(r.id), r.n_tokens))
    _, _, _, _, score = model([[*words(t), None] for _, t in rows])
    want = sorted((str(i), len(words(t)) + 1, score([*words(t), None])) for i, t in rows)
    assert len(got) == len(texts)
    for r, (i, n, s) in zip(got, want):
        assert (str(r.id), r.n_tokens) == (i, n) and r.score == pytest.approx(s, abs=0.03 * n)


def test_edges(documents, nothing):
    got = nt.scores(documents, F.col("doc_id") != 5).collect()
    assert len(got) == documents.count()
    assert sorted(r.n_tokens for r in got if r.id in (7, 8, 9)) == [1, 1, 1]
    assert {r.learnt for r in got if r.id is None} == {False}
    assert nt.scores(nothing, F.lit(True)).count() == 0
    untrained = nt.scores(documents, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in untrained} == {(0, 0, 0.0)}


def test_elias_fano():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        for top in (1, 70, 10**6, 2**45):
            values = np.sort(rng.integers(0, top, n))
            ef = nt.EliasFano.of(values)
            assert (ef[np.arange(n)] == values).all()
            x = rng.integers(0, top + 2, 50)
            zero = np.zeros(50, dtype=np.int64)
            assert (ef.successor(zero, zero + n, x) == np.searchsorted(values, x)).all()


def test_a_search_looks_at_few_values(monkeypatch):
    """Between two samples, however wide the range; it used to halve all of it."""
    rng = np.random.default_rng(4)
    values = np.sort(rng.integers(0, 1 << 40, 1 << 16))
    ef, x = nt.EliasFano.of(values), rng.integers(0, 1 << 40, 5000)
    assert (ef.samples == values[:: nt.SAMPLED]).all()
    looked, get = [], nt.EliasFano.__getitem__
    monkeypatch.setattr(nt.EliasFano, "__getitem__", lambda self, i: looked.append(len(i)) or get(self, i))
    lo, hi = np.zeros(5000, dtype=np.int64), np.full(5000, len(values))
    assert (ef.successor(lo, hi, x) == np.searchsorted(values, x)).all()
    assert sum(looked) < 4 * 5000
    lo = rng.integers(0, len(values), 5000)
    hi = np.minimum(lo + rng.integers(0, 40, 5000), len(values))
    want = [a + np.searchsorted(values[a:b], y) for a, b, y in zip(lo, hi, x)]
    assert (ef.successor(lo, hi, x) == want).all()
    near = values[np.minimum(lo + 3, len(values) - 1)] + rng.integers(-1, 2, 5000)
    want = [a + np.searchsorted(values[a:b], y) for a, b, y in zip(lo, hi, near)]
    assert (ef.successor(lo, hi, near) == want).all()


def test_files_are_compressed_where_that_saves(tmp_path):
    rng = np.random.default_rng(5)
    arrays = {
        "codes": np.repeat(rng.integers(0, 256, 40).astype(np.uint8), 1000), "none": np.zeros(0, dtype=np.int64),
        "bits": rng.integers(0, 1 << 62, 3000).astype(np.uint64), "one": np.array([2.5]), "odd": np.arange(7, dtype=np.uint8),
    }
    path = str(tmp_path / "a.trie")
    nt._write(path, arrays)
    assert os.path.getsize(path) < arrays["bits"].nbytes + 2000
    got = nt._read(path)
    assert list(got) == list(arrays)
    for name, a in arrays.items():
        assert got[name].dtype == a.dtype and (got[name] == a).all() and not isinstance(got[name], np.memmap)


def test_ids_of_frequent_words():
    """Hashes that share their leading bits, the smallest and the greatest among them."""
    rng = np.random.default_rng(6)
    top = np.uint64(2**64 - 1)
    for n in (0, 1, 2, 500):
        hashes = np.unique(np.r_[rng.integers(0, 900, n).astype(np.uint64), top - rng.integers(0, 900, n).astype(np.uint64)])
        rng.shuffle(hashes)
        own = nt.Dictionary(hashes, np.ones(len(hashes) + 10), 1, np.zeros(0, np.int64), np.array([1]), 10, 10)
        asked = np.r_[hashes, np.arange(1000, dtype=np.uint64), top - np.arange(1000, dtype=np.uint64)]
        place = {int(h): i for i, h in enumerate(hashes)}
        for d in (own, pickle.loads(pickle.dumps(own))):
            assert d.frequent(asked).tolist() == [place.get(int(h), -1) for h in asked]
            assert [k >= len(hashes) for k in d.ids(asked)] == [int(h) not in place for h in asked]
    # what follows from the hashes is not sent
    assert len(pickle.dumps(own)) < own.hashes.nbytes + own.p1.nbytes + 2000


def test_frequent_ngrams_are_gone_before_requests(spark, monkeypatch):
    """Sums of words with their own shards, needed by the shards alone, and one broadcast for all steps."""
    monkeypatch.setattr(nt, "SHARD_TOKENS", 8)
    there, sent, real = [], [], nt._gains

    def gains(docs, held, shards):
        folder = os.path.dirname(shards.first().path).removeprefix("file:")
        there.extend(os.listdir(folder))
        sent.append(held)
        return real(docs, held, shards)

    monkeypatch.setattr(nt, "_gains", gains)
    rows = [(i, "a b a b a c a d") for i in range(20)]
    assert nt.scores(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).count() == 20
    assert len(sent[0].value.hot) and there and all(name.endswith(".trie") for name in there)


def test_texts_are_named_once_a_group(spark, monkeypatch):
    """However many shards there are, a lot of texts sends its hashes GROUPS times at most."""
    monkeypatch.setattr(nt, "SHARD_TOKENS", 8)
    monkeypatch.setattr(nt, "GROUPS", 3)
    df = spark.createDataFrame([(i, f"a b c{i % 7} d e{i % 5} a b") for i in range(60)], "doc_id long, text string").repartition(2)
    asked, real = [], type(df).mapInArrow

    def watched(self, func, schema, *more, **named):
        out = real(self, func, schema, *more, **named)
        if "lot long" in str(schema):
            asked.append(out)
        return out

    monkeypatch.setattr(type(df), "mapInArrow", watched)
    got = nt.scores(df, F.lit(True)).collect()
    assert sum(r.n_tokens for r in got) == 60 * 8
    sent = asked[0].collect()
    assert len({r.shard for r in sent if r.shard >= 0}) > 10
    named = collections.Counter(r.lot for r in sent if r.shard < 0)
    assert named and max(named.values()) <= 3
    assert all(len(r["keys"]) <= 60 * 8 for r in sent if r.shard < 0)
