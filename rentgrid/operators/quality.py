"""Checks as one-row DataFrames ``(check_name, n_bad)``; ``report`` adds ``ok``.

Building a check runs nothing. ``enforce`` runs a report, and what it brings to
the driver is the failed rows only, never more than the number of checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AREA_ROOM, AREA_SENTINEL, YEAR_COVERAGE
from ..sources.rates import REASONS, parse_payloads


class QualityError(RuntimeError):
    """A required check found bad rows."""


def _check(name: str, df: DataFrame, bad: Column) -> DataFrame:
    return df.agg(bad.cast("bigint").alias("n_bad")).select(F.lit(name).alias("check_name"), "n_bad")


def _checks(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    """Several checks of one table in a single pass."""
    named = {f"c{i}": item for i, item in enumerate(bad.items())}
    rows = F.array(
        *(F.struct(F.lit(n).alias("check_name"), F.col(c).alias("n_bad")) for c, (n, _) in named.items())
    )
    return df.agg(*(b.cast("bigint").alias(c) for c, (_, b) in named.items())).select(F.inline(rows))


def _balance(plus: Sequence[DataFrame], minus: Sequence[DataFrame]) -> DataFrame:
    """(d): rows of ``plus`` less rows of ``minus``, from plain counts."""
    parts = [df.agg(F.count("*").alias("d")) for df in plus]
    parts += [df.agg((-F.count("*")).alias("d")) for df in minus]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tables_non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        _check(f"tables_non_empty:{name}", df, F.when(F.count("*") == 0, 1).otherwise(0))
        for name, df in tables.items()
    )


def union_row_conservation(parts: Sequence[DataFrame], union: DataFrame) -> DataFrame:
    return _check("union_row_conservation", _balance([union], parts), F.abs(F.sum("d")))


def fact_not_larger(fact: DataFrame, staged: DataFrame) -> DataFrame:
    return _check(
        "fact_not_larger", _balance([fact], [staged]), F.greatest(F.sum("d"), F.lit(0))
    )


def no_null_prices(fact: DataFrame) -> DataFrame:
    return _checks(
        fact,
        {
            f"no_null_prices:{c}": F.count_if(F.col(c).isNull())
            for c in ("precio_clp", "precio_uf_oficial")
        },
    )


def sentinel_consistency(staged: DataFrame) -> DataFrame:
    """Sentinel areas are blanked, room areas kept, and neither loses its price."""
    sentinel = F.col("superficie_categoria") == AREA_SENTINEL
    room = F.col("superficie_categoria") == AREA_ROOM
    area, price = F.col("superficie_m2"), F.col("precio_clp")
    return _checks(
        staged,
        {
            "sentinel_with_area": F.count_if(sentinel & area.isNotNull()),
            "room_without_area": F.count_if(room & area.isNull()),
            "sentinel_without_price": F.count_if(sentinel & price.isNull()),
        },
    )


def dedup_conservation(
    raw: DataFrame, staged: DataFrame, key: str = "id", name: str | None = None
) -> DataFrame:
    """Staging has one row per raw key; ``name`` tells several sources' checks apart."""
    keys = raw.agg((-F.count_distinct(key)).alias("d"))
    rows = staged.agg(F.count("*").alias("d"))
    label = f"dedup_conservation:{name}" if name else "dedup_conservation"
    return _check(label, keys.unionByName(rows), F.abs(F.sum("d")))


def dimension_key_unique(dim: DataFrame, key: str) -> DataFrame:
    return _check("dimension_key_unique", dim, F.count("*") - F.count_distinct(key))


def rate_date_unique(rates: DataFrame) -> DataFrame:
    """A repeated day would multiply listings in the rate join."""
    return _check("rate_date_unique", rates, F.count("*") - F.count_distinct("fecha_dt"))


def one_region_per_place(staged: DataFrame) -> DataFrame:
    regions = staged.where("comuna IS NOT NULL").groupBy("comuna").agg(
        F.count_distinct("region").alias("_n")
    )
    return _check("one_region_per_place", regions, F.count_if(F.col("_n") > 1))


def calendar_covers(fact: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """Days of the fact the calendar lacks (days are collapsed before the join)."""
    days = fact.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    orphans = days.join(calendar, F.col(column) == F.col("fecha"), "left_anti")
    return _check(f"calendar_covers:{column}", orphans, F.coalesce(F.sum("_n"), F.lit(0)))


def known_rows_absent(fact: DataFrame, known: DataFrame, keys: Sequence[str] = ("fuente", "id")) -> DataFrame:
    """Rows of the fact whose key a table of known outliers names."""
    return _check("known_rows_absent", _known(fact, known, keys), F.count("*"))


def _known(fact: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Semi-join with a written id table.

    A small one is broadcast by its size. Beyond that Spark builds a Bloom filter of its
    keys at run time, so that the scan of a large fact drops nearly all rows before the
    shuffle; the join then decides exactly. It does so for a side that a comparison
    narrows: here the keys must not be empty, as those name nothing.
    """
    named = known.select(*keys)
    for key in keys:
        named = named.where(F.col(key) != "")
    return fact.join(named, list(keys), "left_semi")


def known_presence(
    fact: DataFrame, known: DataFrame, keys: Sequence[str] = ("fuente", "id"), by: str = "fuente"
) -> DataFrame:
    """Per group: known keys, those that the fact has, and in how many rows."""
    wanted = known.groupBy(by).agg(F.count("*").alias("n_ids"))
    found = _known(fact, known, keys).groupBy(*keys).agg(F.count("*").alias("_n")).groupBy(by).agg(
        F.count("*").alias("n_ids_presentes"), F.sum("_n").alias("n_filas")
    )
    zero = F.lit(0).cast("bigint")
    return wanted.join(found, by, "left").select(
        by, "n_ids", *(F.coalesce(c, zero).alias(c) for c in ("n_ids_presentes", "n_filas"))
    )


def payload_quality(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads without a series, unparsable dates and NULL values in the series."""
    series = parse_payloads(payloads, column)
    empty = F.col("serie").isNull() | (F.size("serie") == 0)
    points = series.select(F.inline("serie"))
    return _check("payload_without_series", series, F.count_if(empty)).unionByName(
        _checks(
            points,
            {
                "payload_bad_date": F.count_if(
                    F.substring("fecha", 1, 10).try_cast("date").isNull()
                ),
                "payload_null_value": F.count_if(F.col("valor").isNull()),
            },
        )
    )


def landed_quality(points: DataFrame) -> DataFrame:
    """Points and payloads refused, by reason."""
    return _checks(points, {f"payload:{r}": F.count_if(F.col("motivo") == r) for r in REASONS})


def year_coverage(
    rates: DataFrame, years: Sequence[int] | None = None, share: float = YEAR_COVERAGE
) -> DataFrame:
    """Rows per year against its days: (anio, n_dias, dias_esperados, ok).

    ``years`` names the years that must be there; without it, those found.
    """
    found = rates.groupBy(F.year("fecha_dt").alias("anio")).agg(F.count("*").alias("n"))
    if years is not None:
        wanted = rates.sparkSession.range(1).select(
            F.explode(F.lit(sorted(years))).alias("anio")
        )
        found = wanted.join(found, "anio", "left")
    expected = F.dayofyear(F.make_date(F.col("anio"), F.lit(12), F.lit(31)))
    return found.select(
        F.col("anio").cast("bigint").alias("anio"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_dias"),
        expected.cast("bigint").alias("dias_esperados"),
    ).withColumn("ok", F.col("n_dias") >= F.col("dias_esperados") * F.lit(share))


def year_coverage_check(rates: DataFrame, years: Sequence[int]) -> DataFrame:
    return _check("year_coverage", year_coverage(rates, years), F.count_if(~F.col("ok")))


def file_inventory_check(missing: DataFrame) -> DataFrame:
    return _check("file_inventory_complete", missing, F.count("*"))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report(*checks: DataFrame) -> DataFrame:
    return union_all(checks).withColumn("ok", F.col("n_bad") == 0)


def enforce(checks: DataFrame, tolerated: Iterable[str] = ()) -> None:
    failed = checks.where(~F.col("ok") & ~F.col("check_name").isin(list(tolerated))).collect()
    if failed:
        raise QualityError(", ".join(f"{name}={n}" for name, n, _ in failed))


# --- reports that show figures rather than pass or fail ------------------------


def category_population(staged: DataFrame) -> DataFrame:
    kind = F.col("superficie_categoria")
    return staged.groupBy("fuente").agg(
        F.count("*").alias("total"),
        F.count_if(kind == AREA_SENTINEL).alias("excluido_centinela"),
        F.count_if(kind == AREA_ROOM).alias("excluido_habitacion"),
        F.count_if(kind.isin(AREA_SENTINEL, AREA_ROOM)).alias("excluido_no_valida"),
    )


def calendar_summary(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.count("*").alias("n_dias"), F.min("fecha").alias("min_fecha"),
        F.max("fecha").alias("max_fecha"),
    )


def weekday_convention(calendar: DataFrame) -> DataFrame:
    return (
        calendar.groupBy("dia_semana", "nombre_dia", "es_fin_de_semana")
        .agg(F.count("*").alias("n"))
        .orderBy("dia_semana")
    )


def dimension_summary(dim: DataFrame, key: str, group: str) -> DataFrame:
    return dim.agg(
        F.count("*").alias("n_filas"), F.count_distinct(key).alias("n_ids_distintos"),
        F.count_distinct(group).alias("n_regiones"),
    )


def fact_tail_by_source(fact: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("precio_clp"), F.col("superficie_m2"))
    return fact.groupBy("fuente").agg(
        F.count("*").alias("n"), F.round(F.max(ratio), 0).alias("max_precio_por_m2")
    )


def indexed_price_gap(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """Mean gap in percent between the native and the official indexed price.

    The mean runs over all (fact, staging) pairs with the same (fuente, id). The
    pairs are never formed: both sides are summed per key first, and
    ``sum(s / f - 1) = sum(s) * sum(1 / f) - pairs``.
    """
    key = ["fuente", "id"]
    official = F.nullif(F.col("precio_uf_oficial"), F.lit(0.0))
    of_fact = fact.groupBy(*key).agg(
        F.sum(F.lit(1.0) / official).alias("_inverse"), F.count(official).alias("_nf")
    )
    of_staging = staged.groupBy(*key).agg(
        F.sum("precio_uf").alias("_native"), F.count("precio_uf").alias("_ns")
    )
    pairs = F.col("_nf") * F.col("_ns")
    return (
        of_fact.where("_nf > 0")
        .join(of_staging.where("_ns > 0"), key)
        .groupBy("fuente")
        .agg(
            F.round(
                F.sum(F.col("_native") * F.col("_inverse") - pairs) / F.sum(pairs) * 100, 2
            ).alias("diff_pct_promedio")
        )
    )


def constant_dimensions(
    fact: DataFrame, staged: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(fact, staging) pairs with the same (fuente, id), per value of ``columns``."""
    key = ["fuente", "id"]
    of_fact = fact.groupBy(*key).agg(F.count("*").alias("_nf"))
    of_staging = staged.groupBy(*key, *columns).agg(F.count("*").alias("_ns"))
    return (
        of_staging.join(of_fact, key)
        .groupBy(*columns)
        .agg(F.sum(F.col("_nf") * F.col("_ns")).alias("n"))
    )


def outliers_absent(usable: DataFrame, thresholds: DataFrame, fact: DataFrame) -> DataFrame:
    """Listings beyond their source's threshold, and how many of them the fact has."""
    key = ["fuente", "id", "precio_clp", "superficie_m2", "fecha_publicacion", "fecha_scraping"]
    beyond = (
        usable.join(thresholds, "fuente")
        .where(F.col("precio_clp_por_m2") > F.col("umbral"))
        .select(*key)
    )
    in_fact = beyond.join(fact.select(*key), key, "left_semi")
    return beyond.agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("k")).unionByName(
        in_fact.agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("k"))
    ).agg(F.sum("n").alias("n_atipicos"), F.sum("k").alias("n_en_hechos"))


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the row count of each table, as scalar subqueries."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(
        *(df.agg(F.count("*")).scalar().alias(name) for name, df in tables.items())
    )
