"""Labelled rows for the classifiers: what may be learnt, and a bounded sample of it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLOOM_BITS, bloom, in_bloom, keep

SAMPLE = 20_000  # labelled rows a model is fitted on, about; more are thinned by hash


def held_out(id: Column, parts: int, rest: int) -> Column:
    """crc32(id as text) mod ``parts`` is ``rest``; a null id counts as empty text."""
    text = F.coalesce(id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % parts == rest


def sample(
    docs: DataFrame, labels: DataFrame, label: str, id: str, text: str,
    learn: Callable[[Column], Column], features: Callable[[pa.Array], list[bytes]], rows: int = SAMPLE,
) -> tuple[list[bytes], np.ndarray]:
    """(features, labels 0/1) of about ``rows`` labelled documents at most.

    ``learn``: which ids may be used. Only documents of the sample have their features
    made: a fixed-size filter picks them in the scan, the join after it is exact. A
    document of several labels takes their majority (1 at a tie); null labels are none.
    """
    known = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & learn(F.col(id)))
        .groupBy(F.col(id).cast("long").alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    )
    known = keep(known, "labels")
    share = rows / max(rows, known.count())
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    held = docs.sparkSession.sparkContext.broadcast(bloom(chosen.select("id")))

    def task(batches):
        bits = np.unpackbits(np.frombuffer(held.value, dtype=np.uint8), count=BLOOM_BITS).astype(bool)
        for batch in batches:
            take = in_bloom(bits, batch.column(0).to_numpy(zero_copy_only=False))
            if take.any():
                part = batch.filter(pa.array(take))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(features(part.column(1)), pa.binary())], ["id", "x"]
                )

    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    made = texts.where("id is not null").mapInArrow(task, "id long, x binary")
    # fitted in an order of its own, so a model does not depend on partitions
    table = made.join(chosen, "id").select("id", "x", "y").toArrow().sort_by([("id", "ascending"), ("x", "ascending")])
    return table["x"].to_pylist(), table["y"].to_numpy().astype(np.float64)


def scored(docs: DataFrame, text: str, score: Callable[[pa.Array], np.ndarray], with_text: bool = True) -> DataFrame:
    """``row`` (struct of the input's columns, without ``text`` unless wanted) and ``score``."""
    kept = [docs[c] for c in docs.columns if with_text or c != text] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text).cast("string").alias("text"))

    def task(batches):
        for batch in batches:
            values = score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["row", "score"])

    return rows.mapInArrow(task, f"row {rows.schema['row'].dataType.simpleString()}, score double")
