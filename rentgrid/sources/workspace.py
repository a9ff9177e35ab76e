"""Written intermediate tables in the folder all executors share.

A kept table cuts the lineage, survives lost executors, is read back column
pruned, and has a known size, so Spark's own threshold decides whether a join
may broadcast it. That is why no join in this package carries a broadcast hint.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; below the warehouse if none is named and the warehouse is shared.

    A warehouse on a local disk, which is Spark's default, is shared by one machine only.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_SETTING).rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share; {warehouse} is local")
    return f"{warehouse}/_work"


PART_BYTES = 64 << 20


def parts_by_size(df: DataFrame) -> int:
    """Tasks for a sort of a written table: its files' length over PART_BYTES.

    An explicit count is not adapted at run time, so it must follow the input.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(-(-size // PART_BYTES), 1 << 16))


ROWS_AT_ONCE = 600_000
ROWS_WORTH_A_TASK = 50_000


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys in one task each, for a group-by on them; a task holds about ROWS_AT_ONCE.

    A group-by that combines before its shuffle keeps nearly every row of a map task in memory
    where few are copies, and spills them all once a task reads more than it can hold. After
    this shuffle it needs no other, and no task's memory follows the input. Counting a written
    table reads no rows.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = max(-(-rows // ROWS_AT_ONCE), min(cores, rows // ROWS_WORTH_A_TASK), 2)
    return df.repartition(n, *map(F.col, keys))


class Workspace:
    """One run's own folder below the shared one.

    Removed by ``close`` or at the end of a ``with`` block, else when the JVM ends.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/rentgrid-{uuid.uuid4().hex}"
        if root is None:
            fs, path = self._store()
            fs.mkdirs(path)
            fs.deleteOnExit(path)

    def _store(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def close(self) -> None:
        """Remove the folder; tables kept in it can't be read any more."""
        fs, path = self._store()
        fs.delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return the table read back."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


_workspaces: dict[str, Workspace] = {}


def workspace_of(spark: SparkSession) -> Workspace:
    """The application's own workspace."""
    application = spark.sparkContext.applicationId
    if application not in _workspaces:
        _workspaces[application] = Workspace(spark)
    return _workspaces[application]
