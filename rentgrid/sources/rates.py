"""The daily rate series: from landed JSON payloads, or from its raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_from_iso_prefix

PAYLOAD_SCHEMA = "serie array<struct<fecha:string,valor:double>>"


def read_payloads(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Landed JSON files, one payload (one year of days) per file: ``payload, archivo``.

    Files without a byte give no row; they are known from the listing and have an empty
    payload. The driver lists one name per landed year.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    )
    texts = lines.select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("archivo"))
    listed = spark.createDataFrame([(name,) for name in lines.inputFiles()], "archivo string")
    same = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    found = texts.select(same("archivo").alias("_archivo"))
    empty = listed.join(found, same(listed["archivo"]) == F.col("_archivo"), "left_anti").select(
        F.lit("").alias("payload"), "archivo"
    )
    return texts.unionByName(empty)


def parse_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row per payload with its ``serie`` (NULL when the key is missing)."""
    return payloads.select(F.from_json(F.col(column), PAYLOAD_SCHEMA)["serie"].alias("serie"))


def flatten_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Raw series (fecha, valor) of all payloads together."""
    return parse_payloads(payloads, column).select(F.inline("serie"))


def typed_rates(raw: DataFrame) -> DataFrame:
    """Raw (fecha, valor) -> (fecha_dt date, valor_uf double)."""
    return raw.select(
        date_from_iso_prefix("fecha").alias("fecha_dt"),
        F.col("valor").cast("double").alias("valor_uf"),
    )


def rate_series(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads of all years -> series sorted by date."""
    return flatten_payloads(payloads, column).orderBy("fecha")


def write_rate_csv(series: DataFrame, folder: str) -> None:
    series.orderBy("fecha").write.mode("overwrite").option("header", True).csv(folder)


# why a payload or one of its points is kept out of the series; the first that applies
REASONS = (
    "json_invalido", "sin_serie", "serie_vacia", "fecha_invalida", "valor_nulo", "valor_invalido", "fecha_repetida",
)
LANDED_SCHEMA = "serie array<struct<fecha:string,valor:string>>, _corrupt string"


def landed_points(payloads: DataFrame, column: str = "payload", file: str = "archivo") -> DataFrame:
    """Every point of every payload, and why it may not enter the series.

    ``archivo, posicion, fecha, valor, fecha_dt, valor_uf, motivo, contenido``. Parsing is
    permissive: what is no JSON lands in the corrupt-record column, values stay text until
    they are known to be numbers. A payload without points is one row, with its content. A
    day that came before (by file, then position) is refused. Days are told apart in a
    table of one row each, so no day gathers its points in one task.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = payloads.select(
        F.col(file).alias("archivo"), F.col(column).alias("contenido"),
        F.from_json(F.col(column), LANDED_SCHEMA, options).alias("p"),
    )
    points = parsed.select(
        "archivo", "contenido", F.col("p._corrupt").alias("_corrupt"), F.size("p.serie").alias("_n"),
        F.posexplode_outer("p.serie").alias("posicion", "punto"),
    )
    number = F.col("punto.valor").try_cast("double")
    empty = F.when(F.col("_n") == 0, "serie_vacia").when(
        F.col("_corrupt").isNotNull() | F.col("contenido").isNull(), "json_invalido"
    )
    day = F.substring("punto.fecha", 1, 10).try_cast("date")
    own = (
        F.when(day.isNull(), "fecha_invalida").when(F.col("punto.valor").isNull(), "valor_nulo")
        .when(number.isNull() | F.isnan(number), "valor_invalido")
    )
    rows = points.select(
        "archivo", "posicion", F.col("punto.fecha").alias("fecha"), F.col("punto.valor").alias("valor"),
        day.alias("fecha_dt"), number.alias("valor_uf"),
        F.when(F.col("_n") > 0, own).otherwise(F.coalesce(empty, F.lit("sin_serie"))).alias("motivo"),
        F.when(F.coalesce(F.col("_n"), F.lit(0)) <= 0, F.col("contenido")).alias("contenido"),
    )
    place = F.struct("archivo", "posicion")
    first = rows.where("motivo IS NULL").groupBy(F.col("fecha_dt").alias("_dia")).agg(F.min(place).alias("_primero"))
    return rows.join(first, F.col("fecha_dt") == F.col("_dia"), "left").select(
        *(c for c in rows.columns if c not in ("motivo", "contenido")),
        F.when(F.col("motivo").isNull() & (place != F.col("_primero")), "fecha_repetida").otherwise(F.col("motivo")).alias("motivo"),
        "contenido",
    )


def accepted(points: DataFrame) -> DataFrame:
    """Raw series (fecha, valor) of the points without a fault."""
    return points.where(F.col("motivo").isNull()).select("fecha", F.col("valor_uf").alias("valor"))


def refused(points: DataFrame) -> DataFrame:
    """The quarantine: points and payloads with a fault, as they came."""
    return points.where(F.col("motivo").isNotNull()).select("archivo", "posicion", "fecha", "valor", "motivo", "contenido")
