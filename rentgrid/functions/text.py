from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property. A literal
# set keeps trimming a plain byte scan; plain ``trim`` would only know the space.
WHITE_SPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Drop outer Unicode white space."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def title_case_words(c: Column | str) -> Column:
    """``"  LAS   condes "`` -> ``"Las Condes"``; NULL and blank give NULL.

    ``initcap`` is not the same: it keeps runs of inner spaces. Words are split
    on the space only, and higher-order functions keep their order without an
    explode or a shuffle.
    """
    text = trimmed(c)
    words = F.filter(F.split(F.lower(text), " "), lambda w: w != "")
    capital = F.transform(
        words,
        lambda w: F.concat(
            F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2_147_483_647)
        ),
    )
    return F.when(text != "", F.array_join(capital, " "))


def canonical_category(c: Column | str, labels: dict[str, str]) -> Column:
    """Known values, whatever their case, get their label; others stay, trimmed."""
    text = trimmed(c)
    key = F.upper(text)
    out = None
    for known, label in labels.items():
        out = F.when(key == known, label) if out is None else out.when(key == known, label)
    return text if out is None else out.otherwise(text)
