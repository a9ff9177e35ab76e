import numpy as np
import pytest
from pyspark.sql import functions as F

from rentgrid.llm import learned_partitions as lp
from rentgrid.llm import queries


def clusters(n, width=16, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, width))[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, width))


def test_parts_are_balanced_and_cut_few_edges():
    x = clusters(900)
    near = lp.neighbours(x, 8)
    rng = np.random.default_rng(2)
    part = lp.balanced_parts(near, 10, rng)
    assert np.bincount(part, minlength=10).max() <= np.ceil(lp.SLACK * 90)
    inside = (part[near] == part[:, None]).mean()
    assert inside > 0.6 and inside > 3 * (rng.permutation(part)[near] == part[:, None]).mean()


def test_router_visits_the_parts_of_neighbours():
    x = clusters(3000)
    router = lp.fit(x, 12, 10)
    p = router.probabilities(x)
    seen = router.visits(p)
    assert seen[np.arange(len(x)), p.argmax(1)].all() and seen.sum(1).mean() < 8
    near = lp.neighbours(x, 10)
    assert np.take_along_axis(seen, p.argmax(1)[near], 1).mean() > 0.93


SCHEMA = "vec_id long, embedding array<double>, label int, score double, part string"


def exact(rows, k=20):
    """query id -> lists of (vec_id, score), by loops over all rows."""
    good = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and any(v) and all(x is not None and np.isfinite(x) for x in v)}
    out = {}
    for i, v in sorted(good):
        if i % 20 == 0:
            found = {(j, float(np.cumsum(np.array(u) * np.array(v))[-1])) for j, u in good if len(u) == len(v)}
            near = sorted(((j, s) for j, s in found if s == s), key=lambda r: (-r[1], r[0]))[: k + 1]
            out.setdefault(i, []).append([r for r in near if r[0] != i][:k])
    return out


@pytest.fixture
def all_parts(monkeypatch):
    """Every part is visited: what is left is exact."""
    monkeypatch.setattr(lp, "TARGET", 2.0)


def test_odd_rows(spark, all_parts):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(120)]  # many ties
    rows += [(200 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(90)]  # copies, queries among them
    rows += [(400, None), (420, []), (440, [0.0] * 4), (460, [1.0, None, 0.0, 0.0]), (480, [float("nan")] * 4), (500, [float("inf")] * 4)]
    rows += [(None, [1.0] * 4), (60, [9.0, 9.0, 9.0, 9.0]), (0, rows[0][1]), (0, rows[0][1])]
    rows += [(600 + i, [1.0, float(i)]) for i in range(8)] + [(640, [1.0, 1e-200]), (660, [3.0])]
    df = spark.createDataFrame([(i, v, 1, 0.5, "x") for i, v in rows], SCHEMA).repartition(5)
    got = {}
    for r in lp.nearest(df, lambda c: c % 20 == 0).orderBy("query_id", "rank", "vec_id").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = {q: sorted((k + 1, i, s) for one in lists for k, (i, s) in enumerate(one)) for q, lists in exact(rows).items()}
    assert {q: (got.get(q), want[q]) for q in want if want[q] and got.get(q) != want[q]} == {}
    assert 660 not in got and len(got[200]) == 20


def test_huge_and_tiny_components(spark, all_parts):
    rows = [(0, [1e200, 1e200]), (1, [1e200, -1e200]), (2, [1e-200, 1e-200]), (3, [1e-100, 0.0]), (20, [1e-200, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 0.5, "x") for i, v in rows], SCHEMA)
    got = lp.nearest(df, lambda c: c % 20 == 0).where("query_id = 20").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, s) for i, s in exact(rows)[20][0]]


def test_no_rows(spark):
    assert lp.nearest(spark.createDataFrame([], SCHEMA), lambda c: c % 20 == 0).count() == 0


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall(spark, folder):
    folder = f"/root/testdata/{folder}"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.array(table["embedding"].tolist(), dtype=float), table["vec_id"].to_numpy()
    got = queries.op13_learned_partitions(spark, folder).toPandas()
    found = {q: g.sort_values("rank") for q, g in got.groupby("query_id")}
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[ids == ids[i]] = -np.inf
        own = found.pop(ids[i])
        assert own["rank"].tolist() == list(range(1, 21))
        assert np.allclose(own["score"], score[np.searchsorted(ids, own["vec_id"])], rtol=0, atol=1e-12)
        assert (np.diff(own["score"]) <= 0).all()
        hits += len(set(ids[np.lexsort((ids, -score))[:20]]) & set(own["vec_id"]))
    assert not found and hits >= 0.93 * 20 * (ids % 20 == 0).sum()


def test_a_vector_of_a_third_of_the_rows_is_one_entry(spark, all_parts):
    rng = np.random.default_rng(7)
    some = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 1, 0.0, "x") for i in range(400)], SCHEMA)
    hot = spark.range(1000, 1200).select(
        F.col("id").alias("vec_id"), F.array(*(F.lit(float(k)) for k in range(8))).alias("embedding"), F.lit(1).alias("label"),
        F.lit(0.0).alias("score"), F.lit("x").alias("part"),
    )
    got = lp.nearest(some.unionByName(hot), lambda c: c % 20 == 0).where("query_id >= 1000").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, lists in by.items():
        assert [i for _, i in sorted(lists)] == [i for i in range(1000, 1022) if i != q][:20]
    assert len(by) == 10
