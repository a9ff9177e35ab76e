"""Staging -> marts: place and calendar dimensions, fact of usable listings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AREA_VALID, TAIL_QUANTILE
from ..functions import is_weekend, iso_weekday, month_name_es, weekday_name_es
from ..operators.keys import surrogate_key
from ..operators.quantiles import exact_quantiles


def build_place_dim(staged: DataFrame) -> DataFrame:
    """One row per place. ``min(region)`` makes the pick deterministic."""
    places = (
        staged.where(F.col("comuna").isNotNull())
        .groupBy("comuna")
        .agg(F.min("region").alias("region"))
    )
    return surrogate_key(places, "comuna", "comuna_id")


def _calendar_columns() -> list[Column]:
    day = F.col("fecha")
    return [
        day,
        F.year(day).cast("bigint").alias("anio"),
        F.month(day).cast("bigint").alias("mes"),
        F.dayofmonth(day).cast("bigint").alias("dia"),
        F.quarter(day).cast("bigint").alias("trimestre"),
        F.weekofyear(day).cast("bigint").alias("semana_anio"),
        iso_weekday(day).alias("dia_semana"),
        month_name_es(day).alias("nombre_mes"),
        weekday_name_es(day).alias("nombre_dia"),
        is_weekend(day).alias("es_fin_de_semana"),
    ]


def build_calendar_dim(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("fecha")
    )
    return days.select(*_calendar_columns())


def calendar_spanning(df: DataFrame, *date_columns: str) -> DataFrame:
    """The calendar that covers all given date columns of ``df``."""
    lows = [F.min(c) for c in date_columns]
    highs = [F.max(c) for c in date_columns]
    first = F.least(*lows) if len(lows) > 1 else lows[0]
    last = F.greatest(*highs) if len(highs) > 1 else highs[0]
    bounds = df.agg(first.alias("lo"), last.alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("fecha"))
    return days.select(*_calendar_columns())


def usable_listings(staged: DataFrame) -> DataFrame:
    """Listings with a valid area and their price per square metre."""
    return staged.where(F.col("superficie_categoria") == AREA_VALID).select(
        "id", "fuente", "comuna", "contact_type", "superficie_m2",
        "fecha_publicacion", "fecha_scraping", "precio_clp",
        F.try_divide(F.col("precio_clp"), F.col("superficie_m2")).alias("precio_clp_por_m2"),
    )


def ratio_thresholds(usable: DataFrame, quantile: float = TAIL_QUANTILE) -> DataFrame:
    """(fuente, umbral): the tail quantile of each source."""
    return exact_quantiles(usable, ["fuente"], "precio_clp_por_m2", {"umbral": quantile})


def below_threshold(usable: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Keep rows up to their own source's threshold; a NULL ratio is not kept."""
    return usable.join(thresholds, "fuente").where(
        F.col("precio_clp_por_m2") <= F.col("umbral")
    )


def build_fact(
    staged: DataFrame, thresholds: DataFrame, places: DataFrame, rates: DataFrame
) -> DataFrame:
    """The fact, from written tables.

    Thresholds (a row per source), places and rates are small tables with a known
    file size, so Spark's own limit decides whether their joins broadcast; then no
    listing is shuffled by source, place or day.
    """
    kept = below_threshold(usable_listings(staged), thresholds)
    return (
        kept.join(places.select("comuna_id", "comuna"), "comuna", "left")
        .join(rates, F.col("fecha_scraping") == F.col("fecha_dt"), "left")
        .select(
            "id", "fuente", "comuna_id", "contact_type", "superficie_m2",
            "fecha_publicacion", "fecha_scraping", "precio_clp",
            F.try_divide(F.col("precio_clp"), F.col("valor_uf")).alias("precio_uf_oficial"),
        )
    )
