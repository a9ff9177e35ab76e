"""Snapshots of a warehouse: all tables of a run become visible in one step.

A table's rows lie in one folder per snapshot and are partitions of one catalog table; its
public name is a view that reads the snapshot the manifest names last. The manifest is a
folder of small JSON files, one per commit. Publishing adds partitions nobody reads yet and
then renames one file into the manifest, which either happens or does not: every reader
finds all tables of one run, whenever a run fails. Spark evaluates the views' common
subquery once per query and reads the partitions of that snapshot alone.

A session that has read the views keeps the manifest's listing; ``refresh`` makes it look
again. Snapshots before the last KEEP commits are removed at the next commit, so a reader
may go on with the one before.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = 2
ORPHAN_HOURS = 48  # folders of runs that ended without a commit or an abort
COLUMN = "snapshot"
COMMIT_SCHEMA = "seq bigint, snapshot bigint, tables array<string>"


class Store:
    """The few file operations that Spark's writers do not offer, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def make(self, folder: str) -> None:
        self.fs.mkdirs(self.path(folder))

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def create(self, name: str, text: str) -> bool:
        """Write a small file that must not exist; False if another writer was first."""
        draft = self.path(f"{name.rpartition('/')[0]}/.draft-{time.time_ns()}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:  # without the overwrite option a rename refuses an existing target
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), options)
            return True
        except Exception as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise


class Manifest:
    def __init__(self, spark: SparkSession, warehouse: str, namespace: str):
        self.spark, self.namespace = spark, namespace
        self.folder = f"{warehouse.rstrip('/')}/commits"
        self.table = f"`{namespace}`.`commits`"
        self.store = Store(spark, self.folder)

    def register(self) -> None:
        self.store.make(self.folder)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")
        if self.spark.catalog.tableExists(self.table) and not _lies_in(self.spark, self.table, self.folder):
            self.spark.sql(f"DROP TABLE {self.table}")  # of another warehouse
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({COMMIT_SCHEMA}) USING json LOCATION '{self.folder}'")

    def history(self) -> list[tuple[int, int]]:
        """(seq, snapshot) of all kept commits, in order. The files are a handful."""
        files = [n for n in self.store.names(self.folder) if n.startswith("commit-")]
        rows = self.spark.read.schema(COMMIT_SCHEMA).json([f"{self.folder}/{n}" for n in files]) if files else None
        return sorted((r.seq, r.snapshot) for r in rows.collect()) if files else []

    def commit(self, snapshot: int, tables: Iterable[str]) -> int:
        """Make ``snapshot`` the current one."""
        history = self.history()
        seq = history[-1][0] if history else 0
        while True:
            seq += 1
            line = json.dumps({"seq": seq, "snapshot": snapshot, "tables": sorted(tables)})
            if self.store.create(f"{self.folder}/commit-{seq:012d}.json", line + "\n"):
                self.refresh()
                return seq

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.table)

    def current(self) -> str:
        """SQL of the current snapshot's number; NULL before the first commit."""
        return f"(SELECT max_by(snapshot, seq) FROM {self.table})"

    def forget(self, keep: int) -> list[int]:
        """Drop all but the last ``keep`` commits; the snapshots that no commit names any more."""
        history = self.history()
        old, left = history[:-keep], {s for _, s in history[-keep:]}
        for seq, _ in old:
            self.store.remove(f"{self.folder}/commit-{seq:012d}.json")
        if old:
            self.refresh()
        return sorted({s for _, s in old} - left)


def _lies_in(spark: SparkSession, table: str, folder: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").collect()
    bare = lambda p: p.partition(":")[2].lstrip("/") if ":" in p else p.lstrip("/")
    return bool(rows) and bare(rows[0].data_type) == bare(folder)


def refresh(spark: SparkSession, namespace: str) -> None:
    """Let this session's views find commits of other sessions."""
    spark.catalog.refreshTable(f"`{namespace}`.`commits`")


class RunTables:
    """Tables of one run below ``warehouse``; ``publish`` shows them all at once.

    As a context, a run that fails removes what it has written.
    """

    def __init__(self, spark: SparkSession, warehouse: str, namespace: str = "manifest"):
        self.spark = spark
        self.warehouse = warehouse.rstrip("/")
        self.snapshot = time.time_ns() // 1000
        self.manifest = Manifest(spark, self.warehouse, namespace)
        self.store = Store(spark, self.warehouse)
        self.written: dict[tuple[str, str], DataFrame] = {}
        self.views: dict[tuple[str, str], list[str]] = {}
        self.published = False

    def __enter__(self) -> RunTables:
        return self

    def __exit__(self, *_) -> None:
        if not self.published:
            self.abort()

    def _folder(self, namespace: str, name: str, snapshot: int) -> str:
        return f"{self.warehouse}/{namespace}/{name}/{COLUMN}={snapshot}"

    def write(self, df: DataFrame, namespace: str, name: str) -> DataFrame:
        if COLUMN in df.columns:
            raise ValueError(f"{name} has a column named {COLUMN}")
        path = self._folder(namespace, name, self.snapshot)
        self.written[namespace, name] = df
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.written[namespace, name] = table
        return table

    def union_view(self, namespace: str, name: str, parts: list[str]) -> None:
        """Publish ``name`` as UNION ALL of tables of the same namespace."""
        self.views[namespace, name] = parts

    def publish(self, keep: int = KEEP) -> None:
        self.manifest.register()
        for namespace in {namespace for namespace, _ in [*self.written, *self.views]}:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
        for (namespace, name), table in self.written.items():
            self._add(namespace, name, table)
        for (namespace, name), parts in self.views.items():
            union = " UNION ALL ".join(f"SELECT * FROM `{namespace}`.`{p}`" for p in parts)
            self._view(namespace, name, union)
        self.manifest.commit(self.snapshot, [f"{ns}.{name}" for ns, name in self.written])
        self.published = True
        self._clean(self.manifest.forget(keep))

    def _add(self, namespace: str, name: str, table: DataFrame) -> None:
        """Add this run's partition, which the view does not show before the commit."""
        full = f"`{namespace}`.`{name}__snapshots`"
        folder = f"{self.warehouse}/{namespace}/{name}"
        if self.spark.catalog.tableExists(full) and not _lies_in(self.spark, full, folder):
            self.spark.sql(f"DROP TABLE {full}")  # of another warehouse
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns}, {COLUMN} BIGINT) USING parquet "
            f"PARTITIONED BY ({COLUMN}) LOCATION '{folder}'"
        )
        held, own = dict(self.spark.table(full).dtypes), dict(table.dtypes)
        changed = [c for c, t in held.items() if c != COLUMN and own.get(c) != t]
        if changed:
            raise TypeError(f"{namespace}.{name} may gain columns only; changed: {changed}")
        gained = [f.name for f in table.schema if f.name not in held]
        if gained:
            more = ", ".join(f"`{c}` {own[c]}" for c in gained)
            self.spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({more})")
        self.spark.sql(
            f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION ({COLUMN} = {self.snapshot}) "
            f"LOCATION '{self._folder(namespace, name, self.snapshot)}'"
        )
        names = ", ".join(f"`{c}`" for c in table.columns)
        self._view(namespace, name, f"SELECT {names} FROM {full} WHERE {COLUMN} = {self.manifest.current()}")

    def _view(self, namespace: str, name: str, body: str) -> None:
        full = f"`{namespace}`.`{name}`"
        if self.spark.catalog.tableExists(full) and self.spark.catalog.getTable(full).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {full}")  # a table in the view's place
        self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS {body}")

    def abort(self) -> None:
        """Remove what this run has written; readers never saw it."""
        self._drop([self.snapshot])

    def _clean(self, old: list[int]) -> None:
        lost = self.snapshot - ORPHAN_HOURS * 3_600_000_000
        known = {s for _, s in self.manifest.history()}
        for namespace, name in self.written:
            found = self.store.names(f"{self.warehouse}/{namespace}/{name}")
            numbers = [int(n.partition("=")[2]) for n in found if n.startswith(f"{COLUMN}=")]
            old = [*old, *(n for n in numbers if n < lost and n not in known)]
        self._drop(sorted(set(old)))

    def _drop(self, snapshots: list[int]) -> None:
        for namespace, name in self.written:
            for snapshot in snapshots:
                try:
                    self.spark.sql(
                        f"ALTER TABLE `{namespace}`.`{name}__snapshots` DROP IF EXISTS PARTITION ({COLUMN} = {snapshot})"
                    )
                except AnalysisException:
                    pass  # a run may end before its first table is known to the catalog
                self.store.remove(self._folder(namespace, name, snapshot))
