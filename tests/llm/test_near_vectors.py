import numpy as np

from rentgrid.llm import near_vectors as nv


def brute(rows, threshold=0.93):
    def ok(v, label):
        return v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    good = [i is not None and ok(v, label) for i, v, label in rows]
    group, links = list(range(n)), [0] * n
    for a in range(n):
        for b in range(a):
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if good[a] and good[b] and p == q and len(x) == len(y):
                x, y = np.float32(x).astype(float), np.float32(y).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    group = [group[b] if g == group[a] else g for g in group]
    out = []
    for (i, _, _), k, g in zip(rows, links, group):
        least = None if i is None else min(j for (j, _, _), h in zip(rows, group) if h == g and j is not None)
        out.append((i, k, least, least == i))
    return sorted(out, key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int"


def found(df):
    return sorted(map(tuple, nv.near_vectors(df).collect()), key=repr)


def test_edges(spark):
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [1.0, 0.1, 0.0], 1), (3, [2.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 2), (5, [1.0, 0.0, 0.0], None),
        (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [float("nan"), 1.0, 0.0], 1), (9, [1.0, None, 0.0], 1),
        (10, [float("inf"), 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [1.0], 1), (13, [5.0], 1), (1, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0, 0.0], 1), (14, [], 1), (15, [-0.0, 1.0, 0.0], 1), (16, [0.0, 1.0, 0.0], 1),
    ]
    got, want = found(spark.createDataFrame(rows, SCHEMA)), brute(rows)
    assert [(r[:3], r[3] or r[0] is None) for r in got] == [(r[:3], r[3] or r[0] is None) for r in want]


def test_empty(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, None)], SCHEMA)) == [(1, 0, 1, True)]


def test_recall_of_links_at_the_threshold(spark, monkeypatch):
    """Neighbours between the threshold and exact copies, a large group, small blocks."""
    monkeypatch.setattr(nv, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for k in range(60):
        base = rng.normal(size=32)
        base /= np.linalg.norm(base)
        for _ in range(80 if k == 0 else int(rng.integers(1, 6))):
            away = rng.normal(size=32)
            away -= away @ base * base
            c = rng.uniform(0.935, 1.0)
            v = c * base + np.sqrt(1 - c * c) * away / np.linalg.norm(away)
            rows.append((n := n + 1, v.tolist(), k % 3))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, want = found(df), brute(rows)
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))


def test_very_small_and_very_large_vectors(spark):
    """Components near 1e-200 and 1e200, and the smallest there are, link as their cosine says."""
    rng = np.random.default_rng(3)
    base = [rng.normal(size=8) for _ in range(30)]
    rows = [(k, (v + 0.02 * rng.normal(size=8)).tolist(), k % 3) for k, v in enumerate(v for v in base for _ in range(3))]
    odd = [(100 + k, (base[k] * size).tolist(), row[2]) for k, size in enumerate((1e-200, 1e200, 1e-160, 1e160)) for row in [rows[3 * k]]]
    odd += [(200, [5e-324] + [0.0] * 7, 0), (201, [1.7e308] + [0.0] * 7, 0)]
    kind = "vec_id long, embedding array<double>, label int"
    plain = {r[0]: r[1:] for r in found(spark.createDataFrame(rows, kind))}
    got = {r[0]: r[1:] for r in found(spark.createDataFrame(rows + odd, kind))}
    for k in range(4):
        near = [i for i in range(90) if rows[i][2] == rows[3 * k][2] and cosine(rows[i][1], base[k]) >= 0.93]
        assert near and got[100 + k][0] == len(near) and got[100 + k][1] == min(got[i][1] for i in near)
    assert got[200][0] >= 1 and got[201][1] == got[200][1]
    touched = {i for k in range(4) for i in range(90) if rows[i][2] == rows[3 * k][2] and cosine(rows[i][1], base[k]) >= 0.93}
    touched |= {i for i in range(90) if rows[i][2] == 0 and cosine(rows[i][1], [1.0] + [0.0] * 7) >= 0.93}
    assert all(got[i] == plain[i] for i in set(range(90)) - touched)


def cosine(x, y):
    return np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)
