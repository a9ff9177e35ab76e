from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import parts_by_size, workspace_of


def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """1-based consecutive number in an order, without one task that sorts everything.

    Rows are dealt to tasks by ranges of the order and sorted there; the counts of the
    parts (one row per task) are summed in order. Ranges follow the values, so a prefix
    that all names share does not matter.
    """
    work = workspace_of(df.sparkSession)
    df = work.keep(df, "unnumbered")  # read twice, and of a size that is known
    n = parts_by_size(df)
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # task number above 33 bits, place in the task below
    dealt = work.keep(dealt.withColumn("_place", place), "numbered")
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return dealt.join(offsets, part == F.col("_part")).select(
        (F.col("_offset") + inside + 1).cast("bigint").alias(name), *df.columns
    )


def surrogate_key(df: DataFrame, order: str, name: str) -> DataFrame:
    """Consecutive number in the order of a unique string column (code-point order)."""
    return numbered(df, name, order)


def ranked(df: DataFrame, name: str, column: str) -> DataFrame:
    """Rank from the highest value, NULL last; equal values share the best of their places.

    Distinct values are ranked, in one task: for tables of a dimension's size.
    """
    df = workspace_of(df.sparkSession).keep(df, "unranked")
    values = df.groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.col("_value").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    place = (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("bigint")
    ranks = values.select("_value", place.alias(name))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("_value"))).select(*df.columns, name)
