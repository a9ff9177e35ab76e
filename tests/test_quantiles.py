"""Exact quantiles against Spark's own ``percentile`` and against sorting."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentgrid.operators.quantiles import approx_quantiles, exact_quantiles, exact_quantiles_of

LEVELS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}


def expected(df, keys, levels=LEVELS):
    rows = df.groupBy(*keys).agg(
        *(F.percentile("v", p).alias(n) for n, p in levels.items())
    ).where(F.col(next(iter(levels))).isNotNull())
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def actual(df, keys, levels=LEVELS):
    return sorted((tuple(r) for r in exact_quantiles(df, keys, "v", levels).collect()), key=repr)


def check(spark, rows, keys=("k",)):
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got, want = actual(df, list(keys)), expected(df, list(keys))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[: len(keys)] == w[: len(keys)]
        assert g[len(keys):] == pytest.approx(w[len(keys):], rel=1e-12, abs=1e-300, nan_ok=True)


def test_hot_value_and_nulls(spark):
    rows = [("x", 7.0)] * 3000 + [("x", float(i)) for i in range(3000)]
    rows += [("x", None)] * 50 + [(None, 1.5), (None, 2.5), ("only_null", None), ("one", -3.25)]
    check(spark, rows)


def test_narrow_band_and_wide_range(spark):
    rng = random.Random(1)
    rows = [("narrow", 1e6 + rng.random() * 1e-4) for _ in range(2000)]
    rows += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-200, 200)) for _ in range(2000)]
    rows += [("ints", float(rng.randrange(10))) for _ in range(500)]
    check(spark, rows)


def test_no_keys(spark):
    check(spark, [("x", float(i * i)) for i in range(101)], keys=())


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["p", "q", None]),
            st.one_of(
                st.none(),
                st.floats(-1e9, 1e9),
                st.sampled_from([float("nan"), float("inf"), float("-inf"), 5e-324, -5e-324]),
                st.integers(-5, 5).map(float),
            ),
        ),
        min_size=1, max_size=60,
    )
)
def test_any_rows(spark, rows):
    check(spark, rows)


def test_several_columns(spark):
    df = spark.createDataFrame([("x", 1, 10.0), ("x", 3, None)], "k string, a long, b double")
    got = exact_quantiles_of(df, ["k"], {"a": "a", "b": "b"}, {"m": 0.5}).collect()
    assert {(r["metric"], r["m"]) for r in got} == {("a", 2.0), ("b", 10.0)}


def test_approx_rank(spark):
    df = spark.range(1, 10_001).select(F.lit("x").alias("k"), F.col("id").cast("double").alias("v"))
    row = approx_quantiles(df, ["k"], "v", {"p95": 0.95, "p99": 0.99}, 1000).first()
    assert abs(row["p95"] - 9500) <= 11 and abs(row["p99"] - 9900) <= 11
    assert (row["maximo"], row["n_poblacion"]) == (10_000.0, 10_000)
