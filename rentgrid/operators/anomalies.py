"""Evidence for suspicious areas and prices, and the review of a price gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_key
from ..sources.workspace import Workspace
from .profile import day, number, percent


def spike_test(df: DataFrame, area: str, suspects: Sequence[float]) -> DataFrame:
    """Exact hits against near neighbours of each suspect, in one pass, no join.

    The neighbourhood is 0.5 up to 5 and 2 beyond; a spike has no neighbours.
    """
    a = number(area)
    counts, rows = [], []
    for i, v in enumerate(suspects):
        reach = 0.5 if v <= 5 else 2.0
        near = a.between(v - reach, v + reach) & (a != v)
        counts += [F.count_if(a == v).alias(f"e{i}"), F.count_if(near).alias(f"v{i}")]
        rows.append(
            F.struct(
                F.lit(float(v)).alias("valor"), F.col(f"e{i}").alias("n_exacto"),
                F.col(f"v{i}").alias("n_vecinos"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def spike_test_of(df: DataFrame, area: str, suspects: DataFrame, workspace: Workspace) -> DataFrame:
    """The same for a table of suspects (``valor, alcance``): ``valor, n_exacto, n_vecinos``.

    A band join through interval bins. Areas collapse to (value, n) first and are put into
    bins an eighth of the least reach wide. A suspect's band covers some bins wholly, whose
    totals are added up, and two in part, where single values are compared. So a suspect
    meets a bounded number of bins and the values of two, however many rows share them.
    Repeated and NULL suspects count once and not at all; one without hits stays with 0.
    """
    bands = workspace.keep(
        suspects.select(F.col("valor").cast("double").alias("valor"), F.col("alcance").cast("double").alias("alcance"))
        .where("valor IS NOT NULL AND alcance > 0").groupBy("valor").agg(F.max("alcance").alias("alcance")), "sospechas",
    )
    width = (bands.agg(F.min("alcance")).first()[0] or 1.0) / 8
    bin_of = lambda c: F.floor(c / F.lit(width))
    a = number(area)
    values = df.select(a.alias("a")).where("a IS NOT NULL").groupBy("a").agg(F.count("*").alias("n"))
    values = workspace.keep(values.withColumn("b", bin_of(F.col("a"))), "areas")
    low, high = F.col("valor") - F.col("alcance"), F.col("valor") + F.col("alcance")
    bands = bands.select("valor", low.alias("lo"), high.alias("hi"), bin_of(low).alias("first"), bin_of(high).alias("last"))
    totals = values.groupBy("b").agg(F.sum("n").alias("n"))
    whole = bands.where("last > first + 1").select(
        "valor", F.explode(F.sequence(F.col("first") + 1, F.col("last") - 1)).alias("b")
    ).join(totals, "b").select("valor", F.lit(0).cast("bigint").alias("e"), "n")
    edges = bands.select("valor", "lo", "hi", F.explode(F.array_distinct(F.array("first", "last"))).alias("b"))
    part = edges.join(values, "b").where("a BETWEEN lo AND hi").select("valor", F.lit(0).cast("bigint").alias("e"), "n")
    exact = bands.join(values, F.col("valor") == F.col("a")).select("valor", F.col("n").alias("e"), (-F.col("n")).alias("n"))
    none = bands.select("valor", F.lit(0).cast("bigint").alias("e"), F.lit(0).cast("bigint").alias("n"))
    return none.unionByName(whole).unionByName(part).unionByName(exact).groupBy("valor").agg(
        F.sum("e").alias("n_exacto"), F.sum("n").alias("n_vecinos")
    )


def suspect_impact(df: DataFrame, area: str, suspects: Sequence[float]) -> DataFrame:
    """Rows per suspect area and their share of all rows."""
    total = df.agg(F.count("*")).scalar()
    a = number(area)
    return (
        df.select(a.alias("superficie"))
        .where(F.col("superficie").isin(list(suspects)))
        .groupBy("superficie")
        .agg(F.count("*").alias("n"))
        .withColumn("pct_del_total", percent(F.col("n"), total, 3))
        .orderBy("superficie")
    )


def suspect_monthly(
    df: DataFrame, area: str, suspects: Sequence[float], date_column: str = "fecha_scraping"
) -> DataFrame:
    """Monthly share of suspect areas; months without any are left out."""
    rows = df.select(
        F.trunc(day(date_column), "month").alias("_mes"),
        number(area).isin(list(suspects)).alias("_hit"),
    )
    months = rows.groupBy("_mes").agg(
        F.count_if("_hit").alias("n_centinela"), F.count("*").alias("n_total_mes")
    )
    return months.where("n_centinela > 0 AND _mes IS NOT NULL").select(
        month_key("_mes").alias("mes"), "n_centinela", "n_total_mes",
        percent(F.col("n_centinela"), F.col("n_total_mes"), 2).alias("pct"),
    )


def share_range(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lowest and highest monthly share."""
    return monthly.groupBy(*by).agg(F.min("pct").alias("pct_min"), F.max("pct").alias("pct_max"))


def extreme_price_share(
    df: DataFrame, area: str, values: Sequence[float], extreme: Column
) -> DataFrame:
    """Of the rows with these areas, how many have an extreme price."""
    hit = df.where(number(area).isin(list(values)))
    return hit.agg(
        F.count_if(extreme).alias("n_precio_extremo"), F.count("*").alias("n_total")
    ).withColumn("pct", percent(F.col("n_precio_extremo"), F.col("n_total"), 2))


def small_area_prices(df: DataFrame, area: str, price: str, limit: float = 10.0) -> DataFrame:
    """Mean price up to ``limit`` square metres against the rest."""
    a, p = number(area), number(price)
    return df.where(F.col(price).isNotNull()).agg(
        F.count_if(a <= limit).alias("n_chica"),
        F.avg(F.when(a <= limit, p)).alias("precio_prom_chica"),
        F.avg(F.when(a > limit, p)).alias("precio_prom_resto"),
    )


def suspects_by_category(
    df: DataFrame, area: str, values: Sequence[float], category: str
) -> DataFrame:
    return (
        df.where(number(area).isin(list(values)))
        .groupBy(category)
        .agg(F.count("*").alias("n"))
    )


def segment_gap(staged: DataFrame, place: str, low: float, high: float) -> DataFrame:
    """One place and area band by price: a jump shows where the outliers start."""
    return (
        staged.where((F.col("comuna") == place) & F.col("superficie_m2").between(low, high))
        .select(
            "fuente", "id", "precio_clp", "superficie_m2",
            F.round(F.try_divide(F.col("precio_clp"), F.col("superficie_m2")), 0).alias(
                "precio_clp_por_m2"
            ),
        )
        .orderBy("precio_clp", "fuente", "id")
    )


def top_by_ratio(
    df: DataFrame, price: str, area: str, k: int = 40, tie_break: Sequence[str] = ("id",)
) -> DataFrame:
    """The k rows with the highest price per square metre."""
    p, a = number(price), number(area)
    return (
        df.select(
            F.try_divide(p, a).alias("precio_por_m2"), a.alias("superficie"), *tie_break
        )
        .orderBy(F.desc_nulls_last("precio_por_m2"), *tie_break)
        .limit(k)
    )


def top_by_price(
    df: DataFrame, price: str, columns: Sequence[str], k: int = 5,
    tie_break: Sequence[str] = ("id",),
) -> DataFrame:
    """The k dearest rows; ties go by ``tie_break``."""
    return (
        df.withColumn("_precio", number(price))
        .orderBy(F.desc_nulls_last("_precio"), *tie_break)
        .select(*columns)
        .limit(k)
    )


def area_distribution(top: DataFrame) -> DataFrame:
    return top.groupBy("superficie").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "superficie")
