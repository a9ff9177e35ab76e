"""Kept sketches against exact ranks."""

import pytest
from pyspark.sql import functions as F

from rentgrid.operators import sketches as sk

LEVELS = {"p05": 0.05, "p50": 0.5, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    value = F.when(n % 3 == 0, 7.0).when(n % 997 == 0, float("nan")).when(n % 991 != 0, F.xxhash64("id") % 100_003 / 7.0)
    return spark.range(0, 60_000, 1, 6).select(
        F.when(n % 5 == 0, "a").otherwise("b").alias("k"), (n % 12).alias("m"), value.alias("v")
    )


def test_merged_sketches_meet_their_rank_error(spark, rows):
    fine = sk.sketched(rows, ["k", "m"], "v")
    assert fine.count() == 24
    coarse = sk.merged(fine, ["k"])
    found = sk.sketch_quantiles(coarse, ["k"], LEVELS)
    ranks = sk.measured_ranks(rows, found, ["k"], "v", LEVELS).collect()
    assert len(ranks) == 2
    for r in ranks:
        assert max(r[f"error_{p}"] for p in LEVELS) <= 2 * sk.rank_error() + 1 / r.n
    exact = {r.k: r for r in rows.where("not isnan(v)").groupBy("k").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    for r in found.collect():
        assert (r.n, r.minimo, r.maximo) == (exact[r.k].n, exact[r.k].lo, exact[r.k].hi)


def test_measured_ranks_see_a_wrong_answer(spark, rows):
    wrong = spark.createDataFrame([("a", 7.0, 1e9), ("b", -1e9, 7.0)], "k string, p05 double, p50 double")
    found = {r.k: r for r in sk.measured_ranks(rows, wrong, ["k"], "v", {"p05": 0.05, "p50": 0.5}).collect()}
    assert found["a"].error_p05 > 0.25 and found["a"].error_p50 == pytest.approx(0.5)
    assert found["b"].error_p05 == pytest.approx(0.05)


def test_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 1.0), (None, 2.0)], "k string, v double")
    found = sk.sketch_quantiles(sk.merged(sk.sketched(df, ["k"], "v"), ["k"]), ["k"], LEVELS)
    got = {r.k: tuple(r)[1:] for r in found.collect()}
    assert got == {"a": (None, None, None, 0, None, None), "b": (1.0,) * 3 + (1, 1.0, 1.0), None: (2.0,) * 3 + (1, 2.0, 2.0)}
    assert sk.sketch_quantiles(sk.sketched(df.limit(0), ["k"], "v"), ["k"], LEVELS).count() == 0
