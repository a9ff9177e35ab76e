"""Exact interpolated quantiles per group, without a per-group value map.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer and a percentile window sorts a whole group in one task. With two listing
sources either one stops working long before 100 TB. Here the rank is found by
counting instead:

1. a histogram over a fixed, monotone log scale tells which bucket holds the rank.
   Rows combine to bucket counts inside each map task, so next to nothing is
   shuffled, and a value that a third of the rows share costs no more than another;
2. the rows of those buckets alone collapse to (value, n), are cut into equal steps
   of their bucket, and only the values of the step that holds the rank are ordered.

The buckets of step 1 are written as a table of a few rows per group, so the join
that picks the rows of step 2 is sized by Spark from that file. The number of
histogram rows per group has a fixed bound whatever the data (the scale covers all
doubles in ``2 * 710 * LOG_STEPS`` steps). No row is dropped or sampled: the result
equals ``percentile`` on the same rows, at the price of reading them twice. As there, NaN
counts as a value above all others; both infinities have buckets of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import workspace_of

LOG_STEPS = 256
SUB_STEPS = 65_536


def _bucket(v: Column) -> Column:
    """Place on the log scale; NaN last, as in Spark's order of doubles."""
    edge = F.lit(1 << 60)
    scale = F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(float(LOG_STEPS)))
    return (
        F.when(F.isnan(v), edge * 2).when(v == float("inf"), edge).when(v == float("-inf"), -edge).otherwise(scale)
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    quantiles: Mapping[str, float],
) -> DataFrame:
    """One row per group: ``keys`` plus one double per entry of ``quantiles``.

    NULL values are ignored; a group with no value at all has no row. NULL keys
    form a group of their own, as in ``groupBy``. ``df`` is read twice, so it
    should be a table, not a long lineage; the first reading happens at the call.
    """
    return _selected(df, keys, value, quantiles, moments=False)


def described(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``keys, n, media, desviacion, minimo``, the quantiles, ``maximo`` of each group.

    Count, sum and squared deviations are carried by the histogram's buckets and merged
    from there, so they cost no further look at the rows; so are ``sums`` of other columns
    over all rows of a group. A group of NULLs alone has a row with n = 0.
    """
    return _selected(df, keys, value, quantiles, moments=True, sums=sums or {})


def _selected(
    df: DataFrame, keys: Sequence[str], value: str | Column, quantiles: Mapping[str, float], moments: bool,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    sums = sums or {}
    added = [f"x{i}" for i in range(len(sums))]
    spark = df.sparkSession
    value = F.col(value) if isinstance(value, str) else value
    group = [f"k{i}" for i in range(max(1, len(keys)))]
    key_columns = [F.col(k) for k in keys] or [F.lit(0)]
    v = F.col("v")
    rows = (
        df.select(
            *(c.alias(g) for c, g in zip(key_columns, group)), value.cast("double").alias("v"),
            *(c.alias(x) for c, x in zip(sums.values(), added)),
        )
        .withColumn("b", _bucket(v))
    )
    every, rows = rows, rows.where(v.isNotNull()).drop(*added)
    k = ", ".join(group)
    same_group = " AND ".join(f"l.{g} <=> r.{g}" for g in group)
    running = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    has_rank = "exists(t, x -> x.r >= upto - n AND x.r < upto)"
    own_ranks = "filter(t, x -> x.r >= upto - n AND x.r < upto)"
    wanted = ", ".join(
        f"struct({i} AS i, {float(p)!r}D * (total - 1) AS pos, {side} AS upper, "
        f"{rounding}({float(p)!r}D * (total - 1)) AS r)"
        for i, p in enumerate(quantiles.values())
        for side, rounding in (("false", "floor"), ("true", "ceil"))
    )
    buckets = spark.sql(
        f"""
        SELECT {k}, b, min(v) AS lo, max(v) AS hi, count(v) AS n
               {", sum(v) AS s, var_pop(v) * count(v) AS m2" if moments else ""}
               {"".join(f", sum({x}) AS {x}" for x in added)}
        FROM {{rows}} GROUP BY {k}, b
        """,
        rows=every if moments else rows,
    )
    if moments:  # read twice below
        buckets = workspace_of(spark).keep(buckets, "histogram")
    coarse = spark.sql(
        f"""
        WITH ranks AS (
          SELECT *, sum(n) OVER (PARTITION BY {k} ORDER BY b {running}) AS upto,
                 sum(n) OVER (PARTITION BY {k}) AS total
          FROM {{buckets}} WHERE n > 0
        )
        SELECT {k}, b, lo, hi, upto - n AS base, {own_ranks} AS t
        FROM (SELECT *, array({wanted}) AS t FROM ranks) WHERE {has_rank}
        """,
        buckets=buckets,
    )
    coarse = workspace_of(spark).keep(coarse, "buckets")

    picks = ", ".join(
        f"max(CASE WHEN i = {i} AND NOT upper THEN v END) AS lo{i}, "
        f"max(CASE WHEN i = {i} AND upper THEN v END) AS hi{i}, "
        f"max(CASE WHEN i = {i} THEN pos END) AS pos{i}"
        for i in range(len(quantiles))
    )
    named = [
        f"CASE WHEN lo{i} = hi{i} THEN lo{i} "
        f"ELSE (ceil(pos{i}) - pos{i}) * lo{i} + (pos{i} - floor(pos{i})) * hi{i} END AS `{name}`"
        for i, name in enumerate(quantiles)
    ]
    found = spark.sql(
        f"""
        WITH near AS (
          SELECT {", ".join("l." + g for g in group)}, l.b, l.v,
                 CASE WHEN r.hi > r.lo
                      THEN floor((l.v - r.lo) / (r.hi - r.lo) * {float(SUB_STEPS)}D)
                      ELSE 0L END AS s
          FROM {{rows}} l JOIN {{coarse}} r ON {same_group} AND l.b <=> r.b
        ),
        counts AS (SELECT {k}, b, s, v, count(*) AS n FROM near GROUP BY {k}, b, s, v),
        steps AS (SELECT {k}, b, s, sum(n) AS n FROM counts GROUP BY {k}, b, s),
        step_ranks AS (
          SELECT l.*, r.t,
                 r.base + sum(l.n) OVER (
                   PARTITION BY {", ".join("l." + g for g in group)}, l.b
                   ORDER BY l.s {running}) AS upto
          FROM steps l JOIN {{coarse}} r ON {same_group} AND l.b <=> r.b
        ),
        fine AS (
          SELECT {k}, b, s, upto - n AS base, {own_ranks} AS t FROM step_ranks WHERE {has_rank}
        ),
        last AS (
          SELECT l.*, r.t,
                 r.base + sum(l.n) OVER (
                   PARTITION BY {", ".join("l." + g for g in group)}, l.b, l.s
                   ORDER BY l.v {running}) AS upto
          FROM counts l JOIN fine r ON {same_group} AND l.b <=> r.b AND l.s <=> r.s
        ),
        picked AS (SELECT {k}, v, inline({own_ranks}) FROM last),
        ends AS (SELECT {k}, {picks} FROM picked GROUP BY {k})
        SELECT {k}, {", ".join(named)} FROM ends
        """,
        rows=rows,
        coarse=coarse,
    )
    names = [F.col(g).alias(key) for g, key in zip(group, keys)]
    if not moments:
        return found.select(*names, *quantiles)
    # mean and deviations of a group from those of its buckets
    merged = buckets.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("minimo"), F.max("hi").alias("maximo"),
        F.collect_list(F.struct("n", "s", "m2")).alias("b"), *(F.sum(x).alias(x) for x in added),
    )
    mean = F.try_divide("s", "n")
    apart = F.aggregate(
        "b", F.lit(0.0),
        lambda acc, x: acc + F.when(x.n > 0, x.m2 + x.n * (x.s / x.n - mean) * (x.s / x.n - mean)).otherwise(0.0),
    )
    figures = merged.select(
        *group, "n", mean.alias("media"), F.when(F.col("n") > 1, F.sqrt(apart / (F.col("n") - 1))).alias("desviacion"),
        "minimo", "maximo", *added,
    )
    # both sides have one row per group, so a group-by puts them together, NULL keys too
    both = figures.unionByName(found, allowMissingColumns=True)
    shown = ["n", "media", "desviacion", "minimo", *quantiles, "maximo"]
    put = both.groupBy(*group).agg(*(F.max(c).alias(c) for c in [*shown, *added]))
    return put.select(*names, *shown, *(F.col(x).alias(name) for x, name in zip(added, sums)))


def exact_quantiles_of(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str | Column],
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Quantiles of several columns in one pass: long format, with a ``metric`` key."""
    pairs = [
        F.struct(
            F.lit(name).alias("metric"),
            (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"),
        )
        for name, v in values.items()
    ]
    long = df.select(*keys, F.inline(F.array(*pairs)))
    return exact_quantiles(long, [*keys, "metric"], "value", quantiles)


def approx_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """Mergeable sketch; the rank error is at most ``rows / accuracy``."""
    levels = F.array(*(F.lit(float(p)) for p in quantiles.values()))
    sketch = F.percentile_approx(F.col(value), levels, F.lit(accuracy))
    grouped = df.groupBy(*keys).agg(
        sketch.alias("_q"), F.max(value).alias("maximo"), F.count("*").alias("n_poblacion")
    )
    return grouped.select(
        *keys,
        *(F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)),
        "maximo", "n_poblacion",
    )
