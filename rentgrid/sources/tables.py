"""Plain tables and folders: read, replace, count. Runs publish through ``snapshots``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    return spark.table(f"`{namespace}`.`{name}`")


def overwrite_table(df: DataFrame, namespace: str, name: str) -> None:
    """Replace a managed table as a whole; running it twice changes nothing."""
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{namespace}`.`{name}`")


def overwrite_folder(df: DataFrame, path: str) -> DataFrame:
    """The same for a plain Parquet folder."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def loaded_row_count(df: DataFrame) -> int:
    return df.count()

