"""Edge rows of the column functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rentgrid import functions as fn
from rentgrid.config import PROPERTY_LABELS, ROOM_AREAS, SENTINEL_AREAS


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("  ÑUÑOA  del   SUR ", "Ñuñoa Del Sur"),
        ("   ", None),
        (None, None),
        ("\tlas condes\t", "Las Condes"),
        ("  PROVIDENCIA　", "Providencia"),
        ("o'higgins", "O'higgins"),
        ("x", "X"),
    ],
)
def test_title_case(spark, raw, expected):
    assert one(spark, raw, fn.title_case_words("c")) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("departamento", "Departamento"), (" DEPARTAMENTO\t", "Departamento"),
        (" Casa ", "Casa"), (None, None),
    ],
)
def test_canonical_category(spark, raw, expected):
    assert one(spark, raw, fn.canonical_category("c", PROPERTY_LABELS)) == expected


@pytest.mark.parametrize(
    "area, kept, category",
    [
        (999.0, None, "centinela"), (5.0, 5.0, "habitacion"), (44.3, 44.3, "valida"),
        (None, None, "valida"), (0.0, 0.0, "valida"), (1.0, None, "centinela"),
    ],
)
def test_area(spark, area, kept, category):
    c = F.col("c")
    both = F.struct(
        fn.area_without_sentinels(c, SENTINEL_AREAS),
        fn.area_category(c, SENTINEL_AREAS, ROOM_AREAS),
    )
    assert tuple(one(spark, area, both, "double")) == (kept, category)


@pytest.mark.parametrize(
    "price, currency, rate, expected",
    [
        (650000.4, "CLP", 36000.0, (650000, 18.06, False, True, 36000.0)),
        (15.5, "UF", 36000.0, (558000, 15.5, True, False, 36000.0)),
        (650000.0, "CLP", None, (650000, None, False, True, None)),
        (15.5, "UF", None, (None, 15.5, True, False, None)),
        (10.0, "USD", 36000.0, (None, None, False, False, 36000.0)),
        (10.0, None, 36000.0, (None, None, None, None, 36000.0)),
        (2.5, "CLP", 1.0, (3, 2.5, False, True, 1.0)),
    ],
)
def test_currency(spark, price, currency, rate, expected):
    df = spark.createDataFrame([(price, currency, rate)], "p double, c string, r double")
    columns = fn.complete_currency(F.col("p"), F.col("c"), F.col("r"))
    assert tuple(df.select(*(c.alias(n) for n, c in columns.items())).first()) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago", "Asia/Tokyo"])
def test_date_prefix_ignores_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, "2023-04-02 04:00:00+00:00", fn.date_from_iso_prefix("c"))
        assert got == date(2023, 4, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bad_date_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "not a date", fn.date_from_iso_prefix("c"))


def test_weekday_names(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 6, 7)], "d date")
    rows = df.select(
        fn.iso_weekday("d"), fn.weekday_name_es("d"), fn.is_weekend("d"), fn.month_name_es("d"),
        fn.month_key("d"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (1, "Lunes", False, "Enero", "2024-01"),
        (6, "Sábado", True, "Enero", "2024-01"),
        (7, "Domingo", True, "Enero", "2024-01"),
    ]
