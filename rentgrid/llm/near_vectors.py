"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves; each half has its own codebook, and the pairs of code words
are the cells of a product grid. Every vector is in one cell's list. A query visits cells
in ascending order of the two halves' distances (the multi-sequence order) up to a radius,
and every vector in a visited cell is verified by its cosine in double precision.

- **Codebooks** are fitted on the driver on about SAMPLE vectors at most; every vector is
  indexed. A cell's distance from a query is a lower bound of the distance to any vector in
  it, from the planes between code words.
- **Target recall.** The radius is the one that would find the share RECALL of neighbours
  that lie exactly at the threshold, in random directions from the sample's vectors. A
  pair is found if either of the two visits the other's cell, so recall is higher.
- **Copies** (same label, same vector) are one entry with a count.
- **Large cells** are cut into blocks of entries and of queries; each pair of blocks is one
  group of a bounded size. A block returns counts and a spanning set of its links, never
  all pairs.

Vectors are compared only when labels are equal and not null, and lengths are equal. Null
and zero vectors, and those with null or non-finite components, link with nothing: no
links, own component, kept. A null id takes part in nothing and has a null component.
Repeated rows are copies. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import keep

SAMPLE = 20_000
RECALL = 0.999
BLOCK = 1024  # entries, and queries, of a group at most, about


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their norms. They are brought near 1 by a power of two first, which
    rounds nothing, so that no square overflows or vanishes."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0, keepdims=True))
    near = np.ldexp(vectors, -power)
    return near / np.linalg.norm(near, axis=1, keepdims=True)


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unit = _unit(vectors)
    cut = (vectors.shape[1] + 1) // 2
    return unit[:, :cut], unit[:, cut:]


def _distances(x: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared distances of rows to code words."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ code.T + (code * code).sum(1)[None, :], 0)


def _bounds(d: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared lower bounds of the distance from each row to any vector of a word's region.

    A region lies beyond the plane half way between its word and the row's nearest word.
    """
    near = d.argmin(1)
    apart = np.sqrt(_distances(code, code))[near]
    gap = d - d[np.arange(len(d)), near][:, None]
    return np.divide(gap, 2 * apart, out=np.zeros_like(gap), where=apart > 0) ** 2


def codebook(x: np.ndarray, k: int, rng, rounds: int = 10) -> np.ndarray:
    """Lloyd's rounds from a random start; empty words stay where they are."""
    code = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = _distances(x, code).argmin(1)
        n = np.bincount(near, minlength=len(code))
        for c in range(x.shape[1]):
            total = np.bincount(near, x[:, c], len(code))
            code[n > 0, c] = total[n > 0] / n[n > 0]
    return code


class MultiIndex:
    def __init__(self, left: np.ndarray, right: np.ndarray, radius: float):
        self.codes, self.radius = (left, right), radius

    @classmethod
    def fit(cls, vectors: np.ndarray, k: int, threshold: float, recall: float = RECALL, seed: int = 5) -> MultiIndex:
        rng = np.random.default_rng(seed)
        halves = _halves(vectors)
        index = cls(*(codebook(h, k, rng) for h in halves), 0.0)
        unit = np.hstack(halves)
        away = rng.normal(size=unit.shape)
        away -= (away * unit).sum(1, keepdims=True) * unit
        norm = np.linalg.norm(away, axis=1, keepdims=True)
        away = np.divide(away, norm, out=np.zeros_like(away), where=norm > 0)
        there = index.cells(threshold * unit + np.sqrt(1 - threshold**2) * away)
        a, b = (_bounds(_distances(h, c), c) for h, c in zip(halves, index.codes))
        row = np.arange(len(unit))
        found = a[row, there // len(index.codes[1])] + b[row, there % len(index.codes[1])]
        index.radius = float(np.quantile(found, recall)) + 1e-12
        return index

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = (_distances(h, c).argmin(1) for h, c in zip(_halves(vectors), self.codes))
        return a * len(self.codes[1]) + b

    def visits(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Cells of each vector's traversal, nearest first."""
        out = []
        a, b = (_bounds(_distances(h, c), c) for h, c in zip(_halves(vectors), self.codes))
        for x, y in zip(a, b):
            i, j = np.flatnonzero(x <= self.radius), np.flatnonzero(y <= self.radius)
            total = x[i][:, None] + y[j][None, :]
            at = np.argwhere(total <= self.radius)
            order = np.argsort(total[at[:, 0], at[:, 1]], kind="stable")
            out.append(i[at[order, 0]] * len(self.codes[1]) + j[at[order, 1]])
        return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows in double precision, zeros after shorter ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width))
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    row = np.repeat(np.arange(len(column)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _block_links(table: pa.Table, threshold: float, width: int) -> pa.Table:
    """Links between the entries and the queries of a block: (cls, n, root)."""
    kind = table["entry"].to_numpy()
    cls, copies, cell = (table[c].to_numpy() for c in ("cls", "copies", "cell_own"))
    vectors = _unit(_matrix(table["vec"], width))
    y, x = np.flatnonzero(kind), np.flatnonzero(~kind)
    xi, yi = np.nonzero(vectors[x] @ vectors[y].T >= threshold)
    xi, yi = x[xi], y[yi]
    other = cls[xi] != cls[yi]
    xi, yi = xi[other], yi[other]
    # a pair that the other side finds as well is counted there for the other side
    visits = table["visits"].combine_chunks()
    n = visits.value_lengths().to_numpy(zero_copy_only=False)
    n = np.nan_to_num(n).astype(np.int64)
    seen = np.unique((np.repeat(np.arange(len(kind)), n) << 32) | visits.flatten().to_numpy().astype(np.int64))
    want = (yi.astype(np.int64) << 32) | cell[xi]
    place = np.minimum(np.searchsorted(seen, want), max(len(seen) - 1, 0))
    mutual = seen[place] == want if len(seen) else np.zeros(len(want), dtype=bool)
    total = np.bincount(xi, copies[yi], len(kind)) + np.bincount(yi[~mutual], copies[xi[~mutual]], len(kind))
    root = cls.copy()
    while len(xi):
        before = root.copy()
        np.minimum.at(root, xi, root[yi])
        np.minimum.at(root, yi, root[xi])
        if (root == before).all():
            break
    linked = np.zeros(len(kind), dtype=bool)
    linked[xi] = linked[yi] = True
    return pa.table({
        "cls": cls[linked], "n": total[linked].astype(np.int64), "root": root[linked],
    })


def near_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"),
        F.col(label).cast("string").alias("label"),
    )
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("vec", lambda v: v != 0)
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(~bad & some, F.lit(False))
    rows = rows.select("*", F.when(good, F.xxhash64("label", "vec")).alias("cls"))
    classes = keep(
        rows.where("cls is not null").groupBy("cls", "label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    n, width = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return _result(rows, classes.select("cls", F.lit(0).alias("n"), F.col("rep").alias("component_id")))
    share = min(1.0, SAMPLE / n)
    sample = classes.where(F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) < int(share * (1 << 30))).select("cls", "vec")
    sample = sample.toArrow().sort_by("cls")
    index = MultiIndex.fit(_matrix(sample["vec"], width), int(np.clip(np.sqrt(n / 64), 8, 128)), threshold)
    left, right, radius = *index.codes, index.radius

    def assign(batches):
        index = MultiIndex(left, right, radius)
        for batch in batches:
            m = _matrix(batch.column(batch.schema.get_field_index("vec")), width)
            visits = index.visits(m)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(index.cells(m), pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                [*batch.schema.names, "cell", "visits"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    placed = classes.mapInArrow(assign, f"{kinds}, cell int, visits array<int>")
    placed = keep(placed.withColumn("size", F.size("vec")), "placed")
    key = ["label", "size", "cell"]
    asked = placed.select("label", "size", F.explode("visits").alias("cell")).groupBy(key).agg(F.count("*").alias("q"))
    blocks = placed.groupBy(key).agg(F.count("*").alias("e")).join(asked, key).select(
        *key, F.ceil(F.col("e") / BLOCK).cast("int").alias("eb"), F.ceil(F.col("q") / BLOCK).cast("int").alias("qb")
    )
    blocks = keep(blocks, "blocks")
    h = F.xxhash64("cls", F.lit(3))
    every = lambda b: F.explode(F.sequence(F.lit(0), F.col(b) - 1))
    common = ["label", "size", "cell", "cls", "copies", "vec", "cell_own"]
    entries = placed.withColumn("cell_own", F.col("cell")).join(blocks, key).select(
        *common, "visits", F.lit(True).alias("entry"), F.pmod(h, "eb").cast("int").alias("e"), every("qb").alias("q")
    )
    queries = (
        placed.select("label", "size", F.col("cell").alias("cell_own"), "cls", "copies", "vec", F.explode("visits").alias("cell"))
        .join(blocks, key)
        .select(*common, F.lit(None).cast("array<int>").alias("visits"), F.lit(False).alias("entry"), every("eb").alias("e"), F.pmod(h, "qb").cast("int").alias("q"))
    )

    def block(table: pa.Table) -> pa.Table:
        return _block_links(table, threshold, width)

    links = keep(
        entries.unionByName(queries).groupBy(*key, "e", "q").applyInArrow(block, "cls long, n long, root long"), "links"
    )
    counts = links.groupBy("cls").agg(F.sum("n").alias("n"))
    labels = components(links.where("cls <> root"), "cls", "root")
    named = classes.join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", "copies", F.coalesce("component", "cls").alias("comp")
    )
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    done = named.join(least, "comp").join(counts, "cls", "left").select(
        "cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id"
    )
    return _result(rows, keep(done, "classes"))


def _result(rows: DataFrame, classes: DataFrame) -> DataFrame:
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "cls").join(classes, "cls", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
