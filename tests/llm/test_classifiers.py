import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentgrid.llm import labels as lb
from rentgrid.llm import quality_gam as gam
from rentgrid.llm import queries
from rentgrid.llm import toxicity_fm as fm

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, parts, rest, least", [
    ("op3_quality_gam", "quality", 5, 0, 0.97), ("op6_toxicity_fm", "toxic", 4, 2, 0.95),
])
def test_held_out_accuracy(spark, name, label, parts, rest, least):
    got = queries.QUERIES[name](spark, FOLDER)
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or (predicted = 1) <> (score >= 0.3)").isEmpty()
    assert got.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == rest)).isEmpty()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    right = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right >= least


@pytest.mark.parametrize("module", [gam, fm])
def test_edges(spark, documents, nothing, module):
    """No labels, labels of one class, null labels and ids, several labels of one document."""
    schema = "doc_id long, quality int, toxic int"
    label = "quality" if module is gam else "toxic"
    for rows in ([], [(1, 1, 1), (2, 1, 1)], [(1, 1, 1), (1, 0, 0), (10, 0, 0), (None, 1, 1), (7, None, None), (8, 0, 0)]):
        model = module.train(documents, spark.createDataFrame(rows, schema), label)
        scored = module.score(documents, model)
        assert scored.select("row.*").columns == documents.columns
        got = scored.collect()
        assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got)
        blank = {r.score for r in got if not (r.row.text or "")}
        assert len(blank) == 1
        assert module.score(nothing, model).count() == 0
    assert module.train(nothing, spark.createDataFrame([(1, 1, 1)], schema), label) is not None


def test_sample_is_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("y"))
    x, y = lb.sample(docs, labels, "y", "doc_id", "text", lambda c: c < 3000, lambda c: [b"x"] * len(c), rows=500)
    assert 400 < len(x) < 600 and 0.4 < y.mean() < 0.6


def test_figures_of_a_text():
    text = "Ab ab, 12 |\n$$$ ÉÉ\nAb ab, 12 |"
    (row,) = gam.figures(pa.array([text]))
    got = dict(zip(gam.FIGURES, row))
    assert got["words"] == pytest.approx(np.log1p(10)) and got["upper"] == pytest.approx(2 / len(text.encode()))
    assert got["bars"] == pytest.approx(2 / len(text.encode())) and got["marked_words"] == pytest.approx(3 / 10)
    assert got["top_word"] == pytest.approx(2 / 10) and got["repeated_lines"] == pytest.approx(1 / 3)
    assert (gam.figures(pa.array([None, ""], pa.string())) == 0).all()


@pytest.mark.parametrize("label", [lambda a, b: a and b, lambda a, b: a != b])
def test_a_pair_that_matters_only_together(label):
    """Both words together tell the label; in the second case neither does alone."""
    rng = random.Random(4)
    texts, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([*["they"] * a, *["insult"] * b, *(f"w{rng.randrange(300)}" for _ in range(20))]))
        y.append(float(label(a, b)))
    slots = []
    for own, n in fm.terms(pa.array(texts)):
        slots += np.split(own, np.cumsum(n)[:-1])
    model = fm.fit(slots[:2000], np.array(y[:2000]))
    test = slots[2000:]
    score = model.score(np.concatenate(test), np.array([len(t) for t in test]))
    assert ((score >= 0.5) == (np.array(y[2000:]) == 1)).mean() > 0.97
    # a sum over all pairs, written out
    own = [model.slots.tolist().index(s) for s in test[0].tolist() if s in model.slots]
    pairs = sum(model.factors[i] @ model.factors[j] for i in own for j in own if i < j)
    assert model.margin(test[0], np.array([len(test[0])]))[0] == pytest.approx(model.base + model.weight[own].sum() + pairs)


def test_evidence_of_pairs():
    rng = np.random.default_rng(2)
    seen, y = rng.random((400, 5)) < [0.5, 0.3, 0.5, 0.9, 0.1], rng.random(400) < 0.4
    got = fm._evidence_of_pairs([np.flatnonzero(r) for r in seen], y.astype(float), 5)
    for i, j in itertools.combinations(range(5), 2):
        want = 0.0
        for case in itertools.product((False, True), repeat=2):
            own = (seen[:, i] == case[0]) & (seen[:, j] == case[1])
            for label in (False, True):
                n, expected = (own & (y == label)).sum(), own.sum() * (y == label).mean()
                want += 2 * n * np.log(n / expected) if n else 0
        assert got[i, j] == pytest.approx(want) and got[j, i] == pytest.approx(want)
