"""Small raw listings with one row per rule."""

from rentgrid.config import dual_price_source, single_price_source

FIRST, SECOND = single_price_source("portal_a"), dual_price_source("portal_b")
PLACE = "  LAS   condes "


def first(spark, *overrides):
    """Raw rows of the single-price source; each override is a dict over the default."""
    base = dict(
        id="A-1", fuente="a", comuna=PLACE, region="RM", precio="650000", divisa="CLP",
        superficie_m2="50", fecha_publicacion="2023-01-01", fecha_scraping="2023-01-02T10:00:00",
        tipo_propiedad="departamento", tipo_operacion="ARRIENDO", contact_type="agency",
    )
    return _frame(spark, FIRST.columns, base, overrides)


def second(spark, *overrides):
    base = dict(
        id="B-1", fuente="b", comuna=PLACE, region="RM", precio_clp="700000", precio_uf="19.5",
        superficie_total_m2="70", fecha_publicacion="2023-01-01", fecha_scraping="2023-01-03",
        tipo_propiedad="Departamento", tipo_operacion="Arriendo", contact_type="owner_direct",
    )
    return _frame(spark, SECOND.columns, base, overrides)


def rates(spark, rows=(("2023-01-02 03:00:00+00:00", "36000"), ("2023-01-03 03:00:00+00:00", "35000"))):
    return spark.createDataFrame(list(rows), "fecha string, valor string")


def _frame(spark, columns, base, overrides):
    rows = [{**base, **o} for o in (overrides or ({},))]
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)
