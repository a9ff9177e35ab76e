import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rentgrid.llm import texts
from rentgrid.llm.components import components

from .conftest import ALNUM as ALNUM_PATTERN
from .conftest import SPACED as SPACED_PATTERN
from .conftest import words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB9 \t\n.é中-|", max_size=40)), max_size=12), st.integers(1, 30))
def test_words(rows, limit):
    for kind, pattern in ((texts.SPACED, SPACED_PATTERN), (texts.ALNUM, ALNUM_PATTERN)):
        got = []
        for part in texts.words(pa.array(rows, pa.string()), kind, limit):
            for a, b in zip(part.first[:-1], part.first[1:]):
                got.append([part.word(i).decode() for i in range(a, b)])
        assert got == [words(r, pattern) for r in rows]


def test_hashes_follow_words():
    rows = pa.array(["to be or not to be", None, "To BE", "x" * 3_000_000 + " to"])
    found = {}
    for part in texts.words(rows, limit=10):
        for i, h in enumerate(part.hashes()):
            assert found.setdefault(part.word(i), h) == h
    assert len(set(found.values())) == len(found) == 5


@pytest.mark.parametrize("edges, want", [
    ([], {}), ([(1, None), (2, 2)], {}),
    ([(1, 2), (2, 3), (9, 8), (8, 7), (5, 7)], {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 8: 5, 9: 5}),
    ([(i, i + 1) for i in range(40)] + [(i, 100) for i in range(3)], {i: 0 for i in [*range(41), 100]}),
])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == want
