import numpy as np
import pytest
from pyspark.sql import functions as F

from rentgrid.llm import raking

SHARES = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "fr": 0.3}}


def test_marginals_are_met(spark):
    rng = np.random.default_rng(2)
    rows = [(s, la, t, int(rng.integers(1, 500))) for s in "ab" for la in ("en", "fr") for t in ("x", "y", None)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, m long")
    targets = {d: raking.fixed(cells, d, s) for d, s in SHARES.items()} | {"topic": raking.tempered(cells, "topic", 0.5)}
    got = raking.rake(cells, targets, rounds=25).toPandas()
    got["w"] = got.m * got.factor
    total = got.w.sum()
    assert total == pytest.approx(got.m.sum())
    for d, shares in SHARES.items():
        for value, share in shares.items():
            assert got[got[d] == value].w.sum() / total == pytest.approx(share, rel=1e-6)
    # against raking in arrays
    m = np.array([r[3] for r in rows], dtype=float).reshape(2, 2, 3)
    topic = np.sqrt(m.sum((0, 1)))
    f = np.ones_like(m)
    for _ in range(25):
        for axis, want in ((0, [0.5, 0.5]), (1, [0.7, 0.3]), (2, topic / topic.sum())):
            other = tuple(a for a in range(3) if a != axis)
            step = np.array(want) * m.sum() / (m * f).sum(other)
            f = f * step.reshape([-1 if a == axis else 1 for a in range(3)])
    by = {(r.source, r.lang, None if r.topic is None or r.topic != r.topic else r.topic): r.factor for r in got.itertuples()}
    for (s, la, t, _), want in zip(rows, f.ravel()):
        assert by[s, la, t] == pytest.approx(want, rel=1e-6)


def test_edges(documents, nothing):
    got = raking.mix(documents).collect()
    assert len(got) == documents.count()
    assert all(0 <= r.probability <= 1 and r.kept in (True, False) for r in got)
    assert {r.row.row for r in got} == {"x"}
    assert raking.mix(nothing).count() == 0
    blank = documents.where("text is null or trim(text) = ''")
    assert raking.mix(blank).where("kept").count() == blank.count()


def test_draws_follow_probabilities(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("source"), F.lit("en").alias("lang"),
    )
    got = raking.mix(docs, shares={"source": {"small": 0.5, "large": 0.5}}).where("kept").groupBy("source").count().collect()
    n = {r.source: r["count"] for r in got}
    assert n["small"] == 5000 and n["large"] == pytest.approx(5000, rel=0.05)
    assert got == raking.mix(docs, shares={"source": {"small": 0.5, "large": 0.5}}).where("kept").groupBy("source").count().collect()
