import random

import numpy as np
from pyspark.sql import functions as F

from .conftest import TEXTS
from rentgrid.llm import periodic_runs as pr
from rentgrid.llm import queries


def brute(w):
    """Every period in turn: stretches where words that far apart are equal."""
    out, (_, w) = {}, np.unique(np.array(w), return_inverse=True) if len(w) else (0, np.zeros(0, int))
    for q in range(1, len(w) // 4 + 1):
        same = np.flatnonzero(np.diff(np.r_[0, w[q:] == w[:-q], 0]))
        for s, e in zip(same[::2].tolist(), same[1::2].tolist()):
            if e - s + q >= max(6, 4 * q):
                out.setdefault((s, e - s + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def made(rng):
    """Nested, broken and neighbouring repetitions."""
    out = []
    for _ in range(rng.randrange(1, 5)):
        base = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 16, 17, 25, 31, 40]))]
        part = (base * rng.choice([1, 2, 3, 4, 5, 9]))[: -rng.randrange(len(base)) or None]
        if rng.random() < 0.3 and part:
            part[rng.randrange(len(part))] = 99
        out += part * (rng.randrange(1, 6) if rng.random() < 0.3 else 1)
    return out


def test_runs_of_words():
    rng = random.Random(4)
    for _ in range(250):
        texts = [made(rng) if rng.random() < 0.9 else [] for _ in range(rng.randrange(1, 6))]
        first = np.cumsum([0, *map(len, texts)])
        got = pr.runs(np.array([x for t in texts for x in t], dtype=np.int64), first)
        assert [tuple(map(int, r)) for r in got] == [(k, *r) for k, t in enumerate(texts) for r in brute(t)]


def test_positions_are_consistent_and_dense():
    rng = np.random.default_rng(3)
    w = rng.integers(0, 40, 4000)
    w[2000:2900] = w[100:1000]
    w[3100:3160] = 7  # all its windows are highly periodic
    t = 16
    periodic = np.array([len(set(w[i : i + t])) == 1 for i in range(len(w) - t + 1)])
    at, context = pr.synchronising(w, t, periodic)
    seen = {}
    for i, c in zip(at.tolist(), context.tolist()):
        assert seen.setdefault(c, tuple(w[i : i + 2 * t])) == tuple(w[i : i + 2 * t])
    chosen = set(at.tolist())
    assert {i + 1900 for i in chosen if 100 <= i <= 1000 - 2 * t} <= chosen
    dense = [i for i in range(len(w) - 3 * t) if not periodic[i : i + 2 * t].any()]
    assert all(chosen & set(range(i, i + t)) for i in dense) and not chosen & set(range(3100, 3129))
    assert len(at) < 4 * len(w) / t


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def split(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


LOOPS = [
    "a b " * 40 + "c", "x\t\n x  x x\fx x", "Ab ab Ab ab Ab ab Ab ab", "é ü " * 9, "one two three four " * 700, " ".join("abcdefghij" * 5) + " z",
]


def test_table(spark, documents, nothing):
    more = spark.createDataFrame([(100 + k, t, None, None, 0, "x", None, 0.0) for k, t in enumerate(LOOPS * 2)], documents.schema)
    rows = pr.periodic_runs(documents.unionByName(more)).collect()
    assert len(rows) == len(TEXTS) + 2 * len(LOOPS)
    runs = {t: brute(split(t)) for t in {t for _, t in TEXTS} | {*LOOPS}}
    want = sorted((len(split(t)), str(runs[t]), collapsed(split(t), runs[t])) for t in [t for _, t in TEXTS] + LOOPS * 2)
    got = sorted((r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in rows)
    assert got == want
    assert {"doc_id", "row", "clean"} <= set(rows[0].row.asDict())
    assert pr.periodic_runs(nothing).count() == 0


def test_damage_makes_loops(spark):
    import zlib

    text = " ".join(f"w{i}" for i in range(90))
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    odd = [(None, "a b"), (11, None), (11, ""), (11, " \n")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    found = docs.select("doc_id", queries.looped(F.col("doc_id"), F.col("text")).alias("t")).collect()
    w = text.split()
    hit = 0
    for r in found:
        if r.doc_id is None or r.t != text and not (r.t or "").strip():
            continue
        h = zlib.crc32(str(r.doc_id).encode())
        g, own = h // 10, w
        if h % 10 == 0:
            a = g % 90
            p = 1 + (90 - a) // (3 + g % 8)
            own, hit = [w[i] if i < a else w[a + (i - a) % p] for i in range(90)], hit + 1
        assert r.t.split() == own
    assert hit > 5 and found[-4].t == "a b"
