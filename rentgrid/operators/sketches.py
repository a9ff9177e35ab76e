"""Approximate quantiles from mergeable sketches that are kept as a column.

One KLL sketch per group (say source and month) is written once; any coarser span is the
merge of its groups' sketches, a few kilobytes each, and the listings are not read again.
A quantile's rank is off by ``rank_error(k)`` of the group's rows with probability 0.99.
NULL and NaN are not counted. A group without values has a sketch of none and NULL quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 1024


def rank_error(k: int = SKETCH_K) -> float:
    """Published error of a KLL sketch's ranks, as a share of all rows, at 99 percent."""
    return 2.446 / k**0.9433


def sketched(df: DataFrame, keys: Sequence[str], value: str | Column, k: int = SKETCH_K) -> DataFrame:
    """``keys, boceto, n, minimo, maximo``: one sketch per group, combined in the map tasks."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*keys, F.when(~F.isnan(v), v).alias("_v"))
    return rows.groupBy(*keys).agg(
        F.kll_sketch_agg_double("_v", F.lit(k)).alias("boceto"), F.count("_v").alias("n"),
        F.min("_v").alias("minimo"), F.max("_v").alias("maximo"),
    )


def merged(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("boceto").alias("boceto"), F.sum("n").alias("n"),
        F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"),
    )


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """``keys``, one double per entry of ``quantiles``, ``n, minimo, maximo``."""
    levels = F.array(*(F.lit(float(p)) for p in quantiles.values()))
    found = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("boceto", levels))
    return sketches.withColumn("_q", found).select(
        *keys, *(F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)), "n", "minimo", "maximo"
    )


def measured_ranks(
    df: DataFrame, found: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """``keys, n``, and per quantile how far its rank is from the wanted one, as a share of the rows.

    One scan of ``df``, counting; ``found`` is a written table of a row per group. A value
    that many rows share has a range of ranks, of which the nearest counts.
    """
    v = F.col(value)
    table = found.select(*keys, *(F.col(name).alias(f"_{name}") for name in quantiles))
    counts = df.where(v.isNotNull() & ~F.isnan(v)).join(table, list(keys)).groupBy(*keys).agg(
        F.count("*").alias("n"),
        *(F.count_if(v < F.col(f"_{name}")).alias(f"_below_{name}") for name in quantiles),
        *(F.count_if(v <= F.col(f"_{name}")).alias(f"_upto_{name}") for name in quantiles),
    )
    n = F.col("n")
    errors = (
        F.greatest(F.col(f"_below_{name}") / n - p, p - F.col(f"_upto_{name}") / n, F.lit(0.0)).alias(f"error_{name}")
        for name, p in quantiles.items()
    )
    return counts.select(*keys, "n", *errors)
