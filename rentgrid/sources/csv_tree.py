"""Raw CSV trees: header-only schema, every column a string, files inventory."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ".../2023/2023-04.csv" and ".../periodo=2023-04/part-0.csv" both carry the period: the
# file name or the last folder, never a folder above.
PERIOD_IN_PATH = r"[/=](\d{4})-(\d{2})(?:\.csv(?:\.gz)?|/[^/]*)$"
CSV_FILES = "*.{csv,csv.gz}"
ROWS_PER_FILE = 1_000_000
OPEN_FILES = 128
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def list_files(spark: SparkSession, folder: str, pattern: str = CSV_FILES) -> DataFrame:
    """(path, length) of each file below ``folder``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )


def header_columns(spark: SparkSession, folder: str) -> list[str]:
    """Column names of the first file in path order."""
    first = list_files(spark, folder).agg(F.min("path").alias("path")).first()["path"]
    if first is None:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return spark.read.option("header", True).option("inferSchema", False).csv(first).columns


def scan_csv_tree(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """All files of a source as one all-string DataFrame.

    The header of every file is checked against the schema, so a file with moved
    columns fails instead of binding its values to the wrong names.
    """
    names = header_columns(spark, folder)
    if columns is not None and set(columns) - set(names):
        raise ValueError(f"{folder} lacks columns {sorted(set(columns) - set(names))}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", CSV_FILES)
        .csv(folder)
    )
    return raw if columns is None else raw.select(*columns, "_metadata")


def with_source_file(raw: DataFrame) -> DataFrame:
    """Add the name and the period of the file each row came from."""
    return raw.select(
        "*",
        F.col("_metadata.file_name").alias("archivo_origen"),
        period_of_path(F.col("_metadata.file_path")).alias("periodo_archivo"),
    )


def period_of_path(path):
    year = F.regexp_extract(path, PERIOD_IN_PATH, 1)
    month = F.regexp_extract(path, PERIOD_IN_PATH, 2)
    return F.when(year != "", F.concat_ws("-", year, month))


def file_inventory(
    spark: SparkSession, folders: dict[str, str], years: Iterable[int]
) -> DataFrame:
    """Expected (source, month) pairs with no file: ``fuente, periodo``."""
    present = None
    for name, folder in folders.items():
        files = list_files(spark, folder).select(
            F.lit(name).alias("fuente"), period_of_path(F.col("path")).alias("periodo")
        )
        present = files if present is None else present.unionByName(files)
    return missing_periods(present, list(folders), years)


def missing_periods(
    present: DataFrame, sources: Sequence[str], years: Iterable[int]
) -> DataFrame:
    """Expected grid minus what is present."""
    grid = present.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, sources))).alias("fuente"),
        F.lit(sorted(years)).alias("anios"),
    )
    grid = grid.select("fuente", F.explode("anios").alias("anio"))
    grid = grid.select("fuente", "anio", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"))
    expected = grid.select("fuente", F.format_string("%04d-%02d", "anio", "mes").alias("periodo"))
    return expected.join(present.distinct(), ["fuente", "periodo"], "left_anti")


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Rows clustered by period, as ``write_csv_tree`` needs them.

    Rebalancing splits a large period and merges small ones by size.
    """
    return df.hint("rebalance", F.col(period))


def write_csv_tree(
    df: DataFrame, folder: str, period: str, clustered: bool = False, compression: str = "none"
) -> None:
    """One folder per period, all values as they are (outer spaces included).

    Rows are clustered by period first, else each task would write a file per period. With
    ``clustered`` they come from ``by_period`` already: what makes rows wide can then follow
    the shuffle. A task keeps the files of its few periods open instead of sorting its rows
    by period; past OPEN_FILES of them Spark sorts the rest. A packed file is read by one
    task; ROWS_PER_FILE bounds it.
    """
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FILES_SETTING)
    conf.set(OPEN_FILES_SETTING, str(OPEN_FILES))
    try:
        (
            (df if clustered else by_period(df, period)).write.mode("overwrite")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .partitionBy(period)
            .option("header", True)
            .option("compression", compression)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(folder)
        )
    finally:
        conf.set(OPEN_FILES_SETTING, before)
