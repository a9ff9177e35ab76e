"""Approximate nearest neighbours by learned partitions (largest inner product).

- **Neighbour graph.** In one task, on about SAMPLE vectors at most: each one's NEIGHBOURS
  nearest of the sample. The driver gets the fitted weights alone.
- **Balanced partitions** of that graph: parts grow from seeds along edges up to an equal
  size, then vertices move to the part that holds most of their neighbours, as long as no
  part exceeds SLACK times the mean.
- **Classifier.** A network with one hidden layer learns, from a vector's direction, how its
  neighbours are spread over the parts. Every vector is put into its most probable part.
- **Routing.** A query visits parts from the most probable on until their probabilities add
  up to ``mass``: the least that finds TARGET of the neighbours of sample vectors which the
  classifier has not seen. The rest of the table is denser than the sample, so neighbours
  are nearer and recall is higher there.
- **Reranking.** Every vector of a visited part is scored exactly, in double precision,
  summed in order of the components.

Only the model is fitted on a sample; every vector is indexed. Equal vectors are one entry
with their WANTED + 1 least ids, which is all that a list of WANTED can need, so a vector that a third
of the rows share is one. Parts are packed into blocks of about ENTRIES vectors, a large
part into several, and queries are dealt to the blocks that hold parts they visit, QUERIES
to a group; a group returns a list of fixed length for each query.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
rows without an id; they neither ask nor are found. Only vectors of equal length are
compared; a product that is no number is not found. Repeated rows of one id and vector are
one; an id with several vectors asks with each, and is never its own neighbour (such a list
is shorter by the id's further vectors among the nearest). Ties go to the smaller id. With few candidates lists are shorter. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep

SAMPLE = 10_000
NEIGHBOURS = 12
SLACK = 1.1
TARGET = 0.96
WANTED = 20
ENTRIES, QUERIES = 16_384, 4_096
_AT_ONCE = 256  # queries scored at a time


def neighbours(x: np.ndarray, k: int, asked: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` rows with the largest inner product; of each row of ``x``, or of ``asked``."""
    out = []
    rows = x if asked is None else asked
    for lo in range(0, len(rows), 512):
        s = rows[lo : lo + 512] @ x.T
        if asked is None:
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out.append(np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), dtype=int)


def _both_ways(near: np.ndarray) -> list[np.ndarray]:
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    u, v = np.r_[a, b], np.r_[b, a]
    order = np.argsort(u, kind="stable")
    return np.split(v[order], np.cumsum(np.bincount(u, minlength=n))[:-1])


def balanced_parts(near: np.ndarray, m: int, rng, rounds: int = 8) -> np.ndarray:
    """Part of each vertex: few edges between parts, no part above SLACK times the mean."""
    n = len(near)
    edges = _both_ways(near)
    part = np.full(n, -1)
    seeds = iter(rng.permutation(n))
    for p in range(m):
        room = (n - int((part >= 0).sum())) // (m - p)
        pulls: dict[int, int] = {}
        heap: list[tuple[int, int]] = []
        while room:
            while heap and (part[heap[0][1]] >= 0 or -heap[0][0] != pulls[heap[0][1]]):
                heapq.heappop(heap)
            v = heapq.heappop(heap)[1] if heap else next(s for s in seeds if part[s] < 0)
            part[v] = p
            room -= 1
            for u in edges[v].tolist():
                if part[u] < 0:
                    pulls[u] = pulls.get(u, 0) + 1
                    heapq.heappush(heap, (-pulls[u], u))
    size, most = np.bincount(part, minlength=m), int(np.ceil(SLACK * n / m))
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n).tolist():
            pull = np.bincount(part[edges[v]], minlength=m)
            own = part[v]
            pull[size >= most] = -1
            pull[own] = max(pull[own], int((part[edges[v]] == own).sum()))
            best = int(pull.argmax())
            if pull[best] > pull[own]:
                size[own] -= 1
                size[best] += 1
                part[v] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def _directions(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Router:
    first: np.ndarray  # hidden layer, with the constant's row
    second: np.ndarray
    mass: float = 1.0

    @property
    def parts(self) -> int:
        return self.second.shape[1]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(_directions(x) @ self.first[:-1] + self.first[-1], 0)
        z = hidden @ self.second[:-1] + self.second[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def visits(self, p: np.ndarray) -> np.ndarray:
        """Whether each query visits each part."""
        order = np.argsort(-p, axis=1, kind="stable")
        ranked = np.take_along_axis(p, order, 1)
        before = np.cumsum(ranked, axis=1) - ranked
        out = np.zeros(p.shape, dtype=bool)
        np.put_along_axis(out, order, (before < self.mass) | (np.arange(p.shape[1]) == 0), 1)
        return out


def _learn(x: np.ndarray, wanted: np.ndarray, hidden: int, epochs: int, rng) -> Router:
    """Cross entropy by Adam on batches of 256."""
    x = np.column_stack([_directions(x), np.ones(len(x))])
    w = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), rng.normal(0, np.sqrt(1 / hidden), (hidden + 1, wanted.shape[1]))]
    mean, square, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    total = epochs * max(1, -(-len(x) // 256))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            own, step = order[lo : lo + 256], step + 1
            inner = x[own] @ w[0]
            h = np.column_stack([np.maximum(inner, 0), np.ones(len(own))])
            z = h @ w[1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = (z / z.sum(axis=1, keepdims=True) - wanted[own]) / len(own)
            slopes = x[own].T @ ((error @ w[1][:-1].T) * (inner > 0)), h.T @ error
            rate = 0.004 * (1 - step / (total + 1))
            for k, g in enumerate(slopes):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Router(w[0], w[1])


def fit(x: np.ndarray, parts: int, k: int = WANTED, target: float = TARGET, seed: int = 3) -> Router:
    """A router for ``parts`` parts; its mass is set on vectors that it has not learnt from."""
    rng = np.random.default_rng(seed)
    x = x / np.abs(x).max()
    if parts < 2 or len(x) < 40:
        return Router(np.zeros((x.shape[1] + 1, 1)), np.zeros((2, 1)))
    order = rng.permutation(len(x))
    out, held = x[order[: len(x) // 10]], x[order[len(x) // 10 :]]
    near = neighbours(held, min(NEIGHBOURS, len(held) - 1))
    part = balanced_parts(near, parts, rng)
    wanted = np.zeros((len(held), parts))
    np.add.at(wanted, (np.arange(len(held))[:, None], part[near]), 1 / near.shape[1])
    router = _learn(held, wanted, 128, 30, rng)
    place = router.probabilities(held).argmax(axis=1)
    near, p = neighbours(held, min(k, len(held)), out), router.probabilities(out)
    for mass in 1 - np.geomspace(0.9, 1e-4, 60):
        router.mass = float(mass)
        if np.take_along_axis(router.visits(p), place[near], 1).mean() >= target:
            return router
    router.mass = 2.0  # all parts
    return router


def _fitted(sample: DataFrame, width: int, most: int, k: int, target: float) -> Router:
    """A router for ``most`` parts, fewer if the sample has less than 40 vectors for each."""

    def task(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            table = pa.Table.from_batches(batches).sort_by([("rep", "ascending"), ("cls", "ascending")])
            x = _matrix(table["vec"].combine_chunks(), width)
            r = fit(x, max(1, min(most, len(x) // 40)), k, target)
            values = {"first": [r.first.tobytes()], "second": [r.second.tobytes()], "parts": [r.parts], "mass": [r.mass]}
            yield pa.RecordBatch.from_pydict(values)

    rows = sample.repartition(1).mapInArrow(task, "first binary, second binary, parts long, mass double").collect()
    if not rows:
        return Router(np.zeros((width + 1, 1)), np.zeros((2, 1)))
    first, second = np.frombuffer(rows[0].first), np.frombuffer(rows[0].second)
    return Router(first.reshape(width + 1, -1), second.reshape(-1, rows[0].parts), rows[0].mass)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, zeros after shorter ones."""
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (n == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _nearest(q: np.ndarray, x: np.ndarray, seen: np.ndarray, ids: list[np.ndarray], k: int):
    """Per query the ``k`` best (score, id) of the entries it sees, best first."""
    least = np.array([i[0] for i in ids])
    reach = np.linalg.norm(x, axis=1).max(initial=0.0)
    for lo in range(0, len(q), _AT_ONCE):
        own = q[lo : lo + _AT_ONCE]
        with np.errstate(all="ignore"):
            rough = np.where(seen[lo : lo + _AT_ONCE], own @ x.T, -np.inf)
            # the fast product may differ from the ordered sum in its last digits
            slack = 1e-14 * x.shape[1] * np.linalg.norm(own, axis=1) * reach
        rough = np.where(np.isnan(rough), np.inf, rough)  # decided by the ordered sum
        last = np.partition(rough, max(len(x) - k, 0), axis=1)[:, max(len(x) - k, 0)]
        with np.errstate(all="ignore"):
            # beyond the largest numbers the fast product tells nothing: all that are seen
            floor = np.where(np.isfinite(last) & np.isfinite(slack), last - slack, -np.inf)
        for i, (row, low) in enumerate(zip(rough, floor)):
            near = np.flatnonzero((row >= low) & seen[lo + i])
            with np.errstate(all="ignore"):
                score = np.cumsum(x[near] * own[i], axis=1)[:, -1]
            near, score = near[~np.isnan(score)], score[~np.isnan(score)]
            order = np.lexsort((least[near], -score))[:k]
            every = np.concatenate([ids[j] for j in near[order]]) if len(order) else np.zeros(0, np.int64)
            of = np.repeat(score[order], [len(ids[j]) for j in near[order]])
            order = np.lexsort((every, -of))[:k]
            yield of[order], every[order]


def nearest(
    vectors: DataFrame, asks: Callable[[Column], Column], id: str = "vec_id", vector: str = "embedding", k: int = WANTED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id ``asks``."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("vec", lambda v: v != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(~bad & some, F.lit(False)))
    rows = rows.withColumn("cls", F.xxhash64("vec"))
    asking = F.coalesce(asks(F.col("vec_id")).cast("boolean"), F.lit(False))
    # the least ids of each vector: cut to k + 1 in the map tasks, however many share it
    same = Window.partitionBy("cls", "vec")
    least = rows.withColumn("r", F.dense_rank().over(same.orderBy("vec_id"))).where(F.col("r") <= k + 1)
    found = least.groupBy("cls", "vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    asked = keep(rows.where(asking).select("vec_id", "cls", "vec").distinct(), "asked")
    wanted = asked.groupBy("cls", "vec").agg(F.lit(True).alias("asks"))
    classes = found.join(wanted, ["cls", "vec"], "left").select(
        "cls", "ids", "vec", F.coalesce("asks", F.lit(False)).alias("asks"), F.size("vec").alias("size")
    )
    classes = keep(classes.withColumn("rep", F.col("ids")[0]), "classes")
    n, width = classes.agg(F.count("*"), F.max("size")).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(1.0, SAMPLE / n)
    sample = classes.where(F.pmod(F.xxhash64("cls"), F.lit(1 << 30)) < int(share * (1 << 30))).select("rep", "cls", "vec")
    router = _fitted(sample, width, int(np.sqrt(n) / 4), k, TARGET)

    def place(batches):
        for batch in batches:
            p = router.probabilities(_matrix(batch.column(2), width))
            seen = router.visits(p) & batch.column(3).to_numpy(zero_copy_only=False)[:, None]
            visits = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(seen.sum(1))].astype(np.int32)), pa.array(np.nonzero(seen)[1].astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p.argmax(1).astype(np.int32)), visits], [*batch.schema.names, "part", "visits"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    placed = keep(classes.mapInArrow(place, f"{kinds}, part int, visits array<int>"), "placed")
    blocks = _blocks(placed)
    entries = placed.join(blocks, ["size", "part"]).select(
        (F.col("base") + F.pmod(F.xxhash64("rep", "cls"), "e")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("deal"),
        "part", "vec", "ids", F.lit(None).cast("array<int>").alias("visits"), "cls", "rep",
    )
    visits = placed.where("asks").select("size", "cls", "rep", F.explode("visits").alias("part")).join(blocks, ["size", "part"]).select(
        "size", "cls", "rep", "part", F.pmod(F.xxhash64("cls", "rep"), "q").cast("int").alias("deal"),
        F.explode(F.sequence(F.col("base"), F.col("base") + F.col("e") - 1)).alias("block"),
    )
    visits = visits.groupBy("cls", "rep", "block", "deal").agg(F.collect_list("part").alias("visits"))
    asking = visits.join(placed.where("asks").select("cls", "rep", "vec", "ids"), ["cls", "rep"]).select(
        "block", "deal", F.lit(-1).alias("part"), "vec", F.lit(None).cast("array<long>").alias("ids"), "visits", "cls", "rep"
    )

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part = table["part"].to_numpy()
        e, q = np.flatnonzero(part >= 0), np.flatnonzero(part < 0)
        entry, query = table.take(e), table.take(q)
        size = len(table["vec"][0])
        x, own = (_matrix(t["vec"].combine_chunks(), size) if len(t) else np.zeros((0, size)) for t in (entry, query))
        seen = np.zeros((len(q), int(part.max(initial=0)) + 1), dtype=bool)
        lists = query["visits"].to_pylist()
        for row, v in zip(seen, lists):
            row[[p for p in v if p < len(row)]] = True
        ids = [np.array(i, dtype=np.int64) for i in entry["ids"].to_pylist()]
        found = list(_nearest(own, x, seen[:, part[e]], ids, k + 1)) if len(e) and len(q) else []
        return pa.table({
            "cls": query["cls"].slice(0, len(found)), "rep": query["rep"].slice(0, len(found)),
            "scores": pa.array([s for s, _ in found], pa.list_(pa.float64())),
            "ids": pa.array([i for _, i in found], pa.list_(pa.int64())),
        })

    each = entries.unionByName(asking).groupBy("block", "deal").applyInArrow(
        search, "cls long, rep long, scores array<double>, ids array<long>"
    )
    pairs = F.transform(F.arrays_zip("scores", "ids"), lambda p: F.struct((-p.scores).alias("worse"), p.ids.alias("vec_id")))
    merged = each.groupBy("cls", "rep").agg(F.slice(F.sort_array(F.flatten(F.collect_list(pairs))), 1, k + 1).alias("best"))
    members = placed.where("asks").select("cls", "rep", "vec").join(merged, ["cls", "rep"])
    lists = asked.join(members, ["cls", "vec"]).select(
        F.col("vec_id").alias("query_id"), F.slice(F.filter("best", lambda b: b.vec_id != F.col("vec_id")), 1, k).alias("best")
    )
    return lists.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", (-F.col("b.worse")).alias("score")
    )


def _blocks(placed: DataFrame) -> DataFrame:
    """``size, part, base, e, q``: a part lies in the ``e`` blocks from ``base`` on, whose queries make ``q`` groups.

    One row per vector length and part reaches the driver.
    """
    held = placed.groupBy("size", "part").agg(F.count("*").alias("n"))
    visited = placed.where("asks").select("size", F.explode("visits").alias("part")).groupBy("size", "part").agg(F.count("*").alias("v"))
    rows = held.join(visited, ["size", "part"], "left").orderBy("size", "part").collect()
    packs: list[list] = []
    for r in rows:
        new = not packs or packs[-1][0].size != r.size or sum(x.n for x in packs[-1]) + r.n > ENTRIES
        if new:
            packs.append([])
        packs[-1].append(r)
    out, base = [], 0
    for pack in packs:
        e = -(-sum(r.n for r in pack) // ENTRIES)
        q = max(1, -(-sum(r.v or 0 for r in pack) // QUERIES))
        out += [(r.size, r.part, base, e, q) for r in pack]
        base += e
    spark = placed.sparkSession
    return keep(spark.createDataFrame(out, "size int, part int, base long, e long, q int"), "blocks")
