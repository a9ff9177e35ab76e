import random

import numpy as np
import pyarrow as pa

from rentgrid.llm import jaccard_join as jj

from .conftest import words


def brute(rows):
    """Component of each row, in order; rows without an id are None."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if None in (rows[a][0], rows[b][0]) or not x or not y:
                continue
            if 100 * len(x & y) >= 75 * len(x | y) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min(i for (i, _), h in zip(rows, group) if h == g and i is not None) for (i, _), g in zip(rows, group) if i is not None}
    return sorted(
        ((i, len(s), None if i is None else least[g]) for (i, _), s, g in zip(rows, sets, group)), key=repr
    )


def found(df):
    return sorted(map(tuple, jj.near_duplicates(df).select("id", "n_shingles", "component_id").collect()), key=repr)


def test_edges(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(documents) == brute(rows)


def test_empty(nothing):
    assert found(nothing) == []


def test_chains_hubs_and_shared_passages(spark, monkeypatch):
    """Near copies of near copies, a passage in many texts, and a low bound for frequent tokens."""
    monkeypatch.setattr(jj, "LEAST_FREQUENT", 3)
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(400)}"
    passage = [word() for _ in range(25)]
    rows, n = [], 0
    for _ in range(25):
        text = [word() for _ in range(rng.choice([6, 40, 90]))] + passage * rng.randrange(2)
        for _ in range(rng.choice([1, 2, 12])):
            rows.append((n := n + 1, " ".join(text)))
            if len(text) > 10:
                text = list(text)
                text[rng.randrange(len(text))] = word()
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_prefixes_are_necessary():
    """Every pair that links passes all filters, for any sizes near the threshold."""
    rng = np.random.default_rng(1)
    how = jj.DEFAULT
    linked = 0
    for _ in range(400):
        n, m, k = int(rng.integers(1, 60)), int(rng.integers(0, 12)), int(rng.integers(0, 12))
        t = np.unique(rng.integers(0, 2**63, n + m + k).astype(np.uint64))
        rng.shuffle(t)
        x, y = np.sort(t[: n + m]), np.sort(np.r_[t[:n], t[n + m :]])
        if len(y) and jj.linked(x, y, how):
            linked += 1
            assert jj.passes_orders(x, y, how)
            frequent = np.sort(rng.choice(t, len(t) // 2, replace=False))
            a, b = (jj._first_prefix(s, how.prefix(len(s)), frequent) for s in (x, y))
            assert len(np.intersect1d(a, b)) >= how.shared_prefix(len(x), len(y))
    assert linked > 100


def test_lists_stream_over_batches():
    rows = [(1, 1), (1, 1), (2, 1), (2, 2), (2, 3), (2, 3), (3, 5), (4, 1), (4, 9)]
    for size in range(1, 6):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in part]), pa.array([c for _, c in part]), pa.array([10] * len(part), pa.int32())],
                ["token", "cls", "n"],
            )
            for part in (rows[i : i + size] for i in range(0, len(rows), size))
        ]
        got = [(r["token"], r["cls"]) for b in jj._shared_tokens(batches, jj.DEFAULT) for r in b.to_pylist()]
        assert got == [(2, 1), (2, 2), (2, 3), (4, 1), (4, 9)]


def test_repeated_tokens_are_counted_without_copies_of_them():
    import tracemalloc

    from rentgrid.llm.jaccard_join import _repeated

    rng = np.random.default_rng(5)
    for top in (1, 3, 50, 10**9):
        sets = [np.unique(rng.integers(0, top, k)).astype(np.uint64) for k in (1, 40, 7, 100)]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        found, n = _repeated(list(sets))
        assert found.tolist() == values[counts > 1].tolist() and n.tolist() == counts[counts > 1].tolist()
    sets = [rng.integers(0, 1 << 62, 1000).astype(np.uint64) for _ in range(500)]
    tracemalloc.start()
    _repeated(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 500_000 * 8  # np.unique with counts took over three times the tokens


def test_postings_of_a_batch_leave_in_parts(spark, monkeypatch):
    from rentgrid.llm import jaccard_join

    rows = [(k, " ".join(f"w{(k // 2) * 31 + j}" for j in range(60))) for k in range(40)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    found = []
    for size in (1 << 17, 10):
        monkeypatch.setattr(jaccard_join, "POSTED_AT_ONCE", size)
        got = jaccard_join._postings(docs, jaccard_join.DEFAULT, np.zeros(0, dtype=np.uint64))
        found.append((sorted(map(tuple, got.collect())), sorted(map(tuple, jaccard_join.near_duplicates(docs, "id").collect()))))
    assert found[0] == found[1] and len({c for _, _, c in found[0][1]}) == 20
