"""Profiles of one raw source. Raw values are strings, so casts tolerate bad input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import trimmed
from ..sources.workspace import Workspace, spread
from .quantiles import described


def number(c: Column | str) -> Column:
    """Tolerant number: NULL where the text is none; "NaN" means missing too."""
    value = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(value), value)


def day(c: str) -> Column:
    """Tolerant date: NULL where the first ten characters are no date."""
    return F.substring(c, 1, 10).try_cast("date")


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and share of each column, in one pass over the rows."""
    counts = df.agg(
        F.count("*").alias("_total"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns)
    )
    rows = F.array(
        *(F.struct(F.lit(c).alias("columna"), F.col(c).alias("n_nulos")) for c in columns)
    )
    return (
        counts.select("_total", F.inline(rows))
        .select("columna", "n_nulos", percent(F.col("n_nulos"), F.col("_total"), 2).alias("pct_nulos"))
        .orderBy(F.desc("n_nulos"), "columna")
    )


def collapsed(df: DataFrame, columns: Sequence[str], workspace: Workspace) -> DataFrame:
    """Distinct rows and ``_n``, how often each occurs; written once.

    Copies, repeated keys and collisions all follow from it, so the source is shuffled
    once for the three.
    """
    return workspace.keep(spread(df, columns).groupBy(*columns).agg(F.count("*").alias("_n")), "filas")


def exact_duplicate_count(rows: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of identical rows; ``rows`` from ``collapsed``."""
    return rows.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicados"))


def duplicate_key_count(rows: DataFrame, key: str) -> DataFrame:
    """All rows, distinct keys, and the difference; ``rows`` from ``collapsed``."""
    return rows.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count_distinct(key).alias("ids_distintos")
    ).withColumn("diferencia", F.col("total") - F.col("ids_distintos"))


def copies_across_files(df: DataFrame, columns: Sequence[str], file: str) -> DataFrame:
    """Copies with the file as part of the row, and without it.

    Rows collapse per file first, then over files: the file's identity goes along, so one
    pass, and one shuffle, by the columns alone, tells copies inside a file from rows that
    several files deliver. ``n_exactos``:
    rows beyond the first with the file in the row; ``n_entre_archivos``: further files that
    hold a row; ``n_filas_repartidas``: distinct rows that more than one file holds.
    """
    per_file = spread(df, columns).groupBy(*columns, file).agg(F.count("*").alias("_n"))
    rows = per_file.groupBy(*columns).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_inside"), F.count("*").alias("_files")
    )
    zero = F.lit(0).cast("bigint")
    return rows.agg(
        F.coalesce(F.sum("_n"), zero).alias("n_filas"), F.count("*").alias("n_distintas"),
        F.coalesce(F.sum("_inside"), zero).alias("n_exactos"),
        F.coalesce(F.sum(F.col("_files") - 1), zero).alias("n_entre_archivos"),
        F.count_if(F.col("_files") > 1).alias("n_filas_repartidas"),
    )


def key_collisions(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Most distinct values any repeated key has, per column: 1 means true copies.

    0 means that no key repeats, or only with NULLs in that column. ``rows`` come from
    ``collapsed``; only those of repeated keys are compared. Each cell becomes one narrow
    (key, column, value) row and repeats combine before the shuffle, so a key with very
    many rows stays spread out.
    """
    repeated = rows.groupBy(key).agg(F.sum("_n").alias("_n")).where("_n > 1").select(key)
    cells = rows.select(key, *columns).join(repeated, key, "left_semi").select(
        key, F.inline(_named_values(columns))
    )
    values = cells.where(F.col("valor").isNotNull()).distinct()
    most = (
        values.groupBy(key, "columna")
        .agg(F.count("*").alias("_n"))
        .groupBy("columna")
        .agg(F.max("_n").alias("_n"))
    )
    none = rows.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, columns))).alias("columna"),
        F.lit(0).cast("bigint").alias("_n"),
    )
    return most.unionByName(none).groupBy("columna").agg(F.max("_n").alias("max_distintos"))


def _named_values(columns: Sequence[str]) -> Column:
    """Each cell of a row as (columna, valor)."""
    return F.array(
        *(
            F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor"))
            for c in columns
        )
    )


def describe_numeric(df: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, exact quartiles, max of several columns: a row per ``columna`` and group."""
    rows = df.select(*by, F.inline(_numbers(values)))
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    return described(rows, ["columna", *by], "_v", quartiles)


def _numbers(values: Sequence[str]) -> Column:
    """Each number of a row as (columna, _v)."""
    return F.array(*(F.struct(F.lit(c).alias("columna"), number(c).alias("_v")) for c in values))


def nonpositive_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*(F.count_if(number(c) <= 0).alias(c) for c in columns))
    rows = F.array(
        *(F.struct(F.lit(c).alias("columna"), F.col(c).alias("n_no_positivos")) for c in columns)
    )
    return counts.select(F.inline(rows))


def tail_report(
    df: DataFrame, values: Sequence[str], quantile: float, workspace: Workspace, by: str | None = None
) -> DataFrame:
    """Per column (and group): the tail quantile, the maximum, and how many rows lie above it.

    Maxima come from the histogram that finds the quantile; only counting what lies above
    it takes a look at the rows again.
    """
    keys = ["columna"] if by is None else ["columna", by]
    rows = df.select(*keys[1:], F.inline(_numbers(values)))
    rows = rows if by is None else rows.where(F.col(by).isNotNull())
    # one row per group, written, so the join back is sized from its file
    limits = workspace.keep(described(rows, keys, "_v", {"umbral": quantile}).select(*keys, "umbral", "maximo"), "colas")
    return rows.join(limits, keys).groupBy(*keys, "umbral", "maximo").agg(
        F.count_if(F.col("_v") > F.col("umbral")).alias("n_sobre_umbral")
    )


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return (
        rows.groupBy(F.col(column).alias("valor"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(column).alias("columna"), "valor", "n")
        .orderBy(F.desc("n"), "valor")
    )


def strip_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, those with outer white space, and distinct values without it."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct()
    return values.agg(
        F.count("*").alias("n_unicos"),
        F.count_if(F.col("_v") != trimmed("_v")).alias("n_con_espacios"),
        F.count_distinct(trimmed("_v")).alias("n_unicos_sin_espacios"),
    ).select(F.lit(column).alias("columna"), "*")


def date_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unparsable count and range of each date column, in one pass."""
    aggregates = []
    for c in columns:
        aggregates += [
            F.count_if(day(c).isNull()).alias(f"{c}_n"),
            F.min(day(c)).alias(f"{c}_lo"), F.max(day(c)).alias(f"{c}_hi"),
        ]
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("columna"), F.col(f"{c}_n").alias("n_sin_parsear"),
                F.col(f"{c}_lo").alias("desde"), F.col(f"{c}_hi").alias("hasta"),
            )
            for c in columns
        )
    )
    return df.agg(*aggregates).select(F.inline(rows))


def published_after_capture(df: DataFrame) -> DataFrame:
    late = day("fecha_publicacion") > day("fecha_scraping")
    return df.agg(F.count_if(late).alias("n_inconsistentes"), F.count("*").alias("n_total"))


def indexed_price_missing(df: DataFrame, indexed: str, local: str) -> DataFrame:
    missing = F.col(indexed).isNull() & F.col(local).isNotNull()
    return df.agg(F.count_if(missing).alias("n_sin_precio_indexado"))


def rows_per_file(df: DataFrame, file_column: str = "archivo_origen") -> DataFrame:
    return df.groupBy(file_column).agg(F.count("*").alias("n")).orderBy(file_column)


def id_overlap(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """How many key values the two sources share.

    Each side is made distinct first: repeats combine before the shuffle, and the
    join then finds both sides partitioned already.
    """
    shared = first.select(key).distinct().join(second.select(key).distinct(), key, "left_semi")
    return shared.agg(F.count("*").alias("n_compartidos"))


def id_prefixes(df: DataFrame, key: str = "id", length: int = 3) -> DataFrame:
    """Key prefixes and their row counts."""
    return df.groupBy(F.substring(key, 1, length).alias("prefijo")).agg(F.count("*").alias("n"))


def head(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)


def value_counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequencies of several columns, NULL included, from one scan."""
    cells = df.select(F.inline(_named_values(columns)))
    return cells.groupBy("columna", "valor").agg(F.count("*").alias("n"))


def source_profile(
    df: DataFrame, collapsed_rows: DataFrame, columns: Sequence[str], numbers: Sequence[str],
    categories: Sequence[str], dates: Sequence[str], stripped: str, key: str = "id",
) -> DataFrame:
    """The profiles of one source in long format: (metrica, columna, valor, n).

    Everything that is a plain count over the rows shares one scan, and so do the
    frequencies of all categories; copies, keys and collisions share the collapsed rows.
    """

    def rows(source: DataFrame, entries: Sequence[tuple[str, str | None, Column]]) -> DataFrame:
        structs = [
            F.struct(
                F.lit(metric).alias("metrica"), F.lit(column).cast("string").alias("columna"),
                F.lit(None).cast("string").alias("valor"), n.cast("bigint").alias("n"),
            )
            for metric, column, n in entries
        ]
        return source.select(F.inline(F.array(*structs)))

    counted = [("nulos", c, F.count_if(F.col(c).isNull())) for c in columns]
    counted += [("no_positivos", c, F.count_if(number(c) <= 0)) for c in numbers]
    counted += [("sin_parsear", c, F.count_if(day(c).isNull())) for c in dates]
    counted.append(
        (
            "publicacion_posterior", "fecha_publicacion",
            F.count_if(day("fecha_publicacion") > day("fecha_scraping")),
        )
    )
    plain = df.agg(*(n.alias(f"n{i}") for i, (_, _, n) in enumerate(counted)))
    values = strip_profile(df, stripped)
    parts = [
        rows(plain, [(m, c, F.col(f"n{i}")) for i, (m, c, _) in enumerate(counted)]),
        rows(exact_duplicate_count(collapsed_rows), [("copias", None, F.col("n_duplicados"))]),
        rows(duplicate_key_count(collapsed_rows, key), [("id_repetido", key, F.col("diferencia"))]),
        key_collisions(collapsed_rows, key, [c for c in columns if c != key]).select(
            F.lit("max_distintos").alias("metrica"), "columna",
            F.lit(None).cast("string").alias("valor"), F.col("max_distintos").alias("n"),
        ),
        rows(
            values,
            [
                ("unicos", stripped, F.col("n_unicos")),
                ("con_espacios", stripped, F.col("n_con_espacios")),
                ("unicos_sin_espacios", stripped, F.col("n_unicos_sin_espacios")),
            ],
        ),
        value_counts_of(df, categories).select(F.lit("frecuencia").alias("metrica"), "*"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
