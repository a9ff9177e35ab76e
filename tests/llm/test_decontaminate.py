import random

import numpy as np
import pytest

from rentgrid.llm import decontaminate as dc

from .conftest import ALNUM, words


def brute(text, items, width=10):
    w = words(text, ALNUM)
    hit, found = set(), set()
    for item, own in items:
        v = words(own, ALNUM)
        m = min(width, len(v))
        for j in range(len(v) - m + 1) if m and item is not None else ():
            for i in range(len(w) - m + 1):
                if w[i : i + m] == v[j : j + m]:
                    hit |= set(range(i, i + m))
                    found.add(item)
    return len(w), len(hit), sorted(found)


ITEMS = [
    ("b", "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), ("a", "one-two; three"), ("a", "xi omicron pi rho sigma tau upsilon"),
    ("c", None), ("d", "..."), (None, "gamma delta"), ("e", "w0 w2916 w829"), ("f", "nowhere to be found in any of these texts at all"),
]


@pytest.mark.parametrize("block", [dc.BLOCK_WORDS, 1])
def test_edges(spark, documents, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    for r in dc.contamination(documents, items).collect():
        text = next(t for t in [r.row.n_chars] if t is not None)
        assert r.row.clean is None and r.row.score == 0.5 and text >= 0
    got = {}
    for r in dc.contamination(documents.withColumnRenamed("row", "text2"), items).collect():
        got.setdefault(r.row.doc_id, []).append((r.n_words, r.n_hit, r.items, r.clean))
    for doc, text in [(r.doc_id, r.text) for r in documents.collect()]:
        n, hit, found = brute(text, ITEMS)
        own = [x for x in got[doc] if x[:3] == (n, hit, found)]
        assert own
        if not hit:
            assert any(x[3] == text for x in own)
        else:
            assert all(len(words(x[3], ALNUM)) == n - hit for x in own)


def test_empty(spark, documents, nothing):
    none = spark.createDataFrame([], "item_id string, text string")
    assert dc.contamination(nothing, none).count() == 0
    assert dc.contamination(documents, none).where("n_hit > 0").count() == 0


def test_index_against_search():
    rng = random.Random(5)
    for _ in range(60):
        sigma = rng.randrange(2, 6)
        text = [rng.randrange(sigma) for _ in range(rng.randrange(0, 80))] + [0]
        index = dc.FMIndex(np.array(text), sigma, sample=rng.choice([1, 3, 32]))
        for m in (1, 2, 5):
            phrases = np.array([[rng.randrange(1, sigma) for _ in range(m)] for _ in range(8)])
            lo, hi = index.search(phrases)
            for p, a, b in zip(phrases.tolist(), lo, hi):
                at = sorted(index.locate(np.arange(a, b)).tolist())
                assert at == [i for i in range(len(text) - m + 1) if text[i : i + m] == p]
