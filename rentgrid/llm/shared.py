"""What several operators use: kept tables, and fixed-size membership filters."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import workspace_of
from .texts import mix

BLOOM_BITS = 1 << 23  # 1 MB, whatever the data
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    return workspace_of(df.sparkSession).keep(df, label)


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder of its own below the shared one."""
    return workspace_of(spark).path(label)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets its rows in Arrow batches of about BATCH_BYTES.

    By rows alone a batch of texts has 20 MB and more, which an executor holds several
    times for each task: as it grows in the JVM, and in the worker with the one before.
    """
    conf = spark.conf
    before = conf.get(BATCH_SETTING)
    conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        conf.set(BATCH_SETTING, before)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    Spark frees them when the driver's JVM collects the plan, which a driver with
    little to do may not get to before the next large shuffle.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _positions(ids: np.ndarray) -> np.ndarray:
    h = mix(ids.view(np.uint64))
    return np.stack([h & np.uint64(BLOOM_BITS - 1), (h >> np.uint64(32)) & np.uint64(BLOOM_BITS - 1)])


def bloom(ids: DataFrame) -> bytes:
    """Bloom filter of one long column: a fixed 1 MB, built in the tasks.

    Each task returns the set bytes of its own filter; they are or-ed per byte, so
    at most BLOOM_BITS / 8 rows reach the driver. It only saves reading and
    shuffling: an exact join always follows.
    """

    def local(batches):
        bits = np.zeros(BLOOM_BITS, dtype=bool)
        for batch in batches:
            ids = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            bits[_positions(ids).ravel()] = True
        packed = np.packbits(bits)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(packed[at].astype(np.int16))], ["at", "bits"]
        )

    rows = ids.mapInArrow(local, "at int, bits smallint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = rows.toArrow()
    out = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    out[table["at"].to_numpy()] = table["bits"].to_numpy().astype(np.uint8)
    return out.tobytes()


def in_bloom(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``bits``: the filter unpacked to one bool per bit."""
    a, b = _positions(ids.astype(np.int64))
    return bits[a] & bits[b]


PART_BYTES = 64 << 20


def parts_of(df: DataFrame) -> int:
    """Tasks for a sort of ``df``: its size as Spark estimates it (files: their length) over PART_BYTES.

    An explicit count is not adapted at run time, so it must grow with the input.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(-(-size // PART_BYTES), 1 << 16))
