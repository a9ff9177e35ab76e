"""Documents with everything that may go wrong, shared by the operators' tests."""

import re

import pytest

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text, pattern=SPACED):
    return re.findall(pattern, (text or "").translate(LOWER))


LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
PLAIN = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
TEXTS = [
    (1, PLAIN), (2, PLAIN), (3, PLAIN.replace("kappa", "KAPPA")), (4, PLAIN + " phi"), (5, "one two three"),
    (6, "One\ttwo \n three"), (7, None), (8, ""), (9, " \n\t "), (10, LONG), (11, LONG + " end"), (12, "ÑUÑOA é 中文 !!!"),
    (5, "one two three"), (14, "Licensed under the Apache License, Version 2.0.\nfree text"), (None, PLAIN), (None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, clean string, score double"


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeats, names that clash."""
    rows = [(i, t, None if k % 3 else "en", "hot" if k % 2 else None, len(t or ""), "x", None, 0.5) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
