"""The registered queries against their SQL, on the smallest tables."""

import pytest
from compare import difference, duck

import corpus_pipeline
from rentgrid.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.ORACLES[name]) is None


def test_all_are_registered():
    import __spark_entry__ as entry

    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_other_queries_have_rows(spark):
    assert queries.QUERIES["op9_chat_repair"](spark, FOLDER).where("rendered not like '%<|end|>%'").isEmpty()
