"""Each stage against a plain version of its rule, on its own input."""

import corpus_pipeline as cp
from rentgrid.llm.shared import keep

from .conftest import ALNUM, words
from .test_decontaminate import brute as hits
from .test_jaccard_join import brute as groups

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rows, after = {}, {}
    for name, stage in cp.STAGES:
        rows[name] = {r.doc_id: r for r in docs.collect()}
        docs = keep(stage(spark, docs, FOLDER), name)
        after[name] = {r.doc_id: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == columns
    assert 0 < len(after["quality"]) < len(rows["quality"])
    assert all(rows["quality"][i] == r for i, r in after["quality"].items())
    keepers = {i for i, _, c in groups([(i, r.text) for i, r in rows["near_copies"].items()]) if i == c}
    assert set(after["near_copies"]) == keepers
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for i, r in rows["leaks"].items():
        n, hit, _ = hits(r.text, items)
        if not hit:
            assert after["leaks"][i] == r
        elif hit < n:
            assert len(words(after["leaks"][i].text, ALNUM)) == n - hit
            assert after["leaks"][i].n_chars == len(after["leaks"][i].text)
        else:
            assert i not in after["leaks"]
    assert after["mixture"] and all(rows["mixture"][i] == r for i, r in after["mixture"].items())
    assert set(after["tokens"]) == set(rows["tokens"])
    assert sum(r.n_tokens for r in after["tokens"].values()) == max(r.start + r.n_tokens for r in after["tokens"].values())


def test_edges(spark, documents, nothing):
    """Nulls, repeats and empty tables pass every stage."""
    for docs in (documents, nothing):
        for name, stage in cp.STAGES:
            if name == "quality":
                continue  # no labels fit these rows
            out = keep(stage(spark, docs, FOLDER), name)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= docs.count()
    kept = cp.near_copies(spark, documents, FOLDER)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 5, 7, 8, 9, 10, 12, 14]
    assert kept.where("doc_id is null").count() == 2
