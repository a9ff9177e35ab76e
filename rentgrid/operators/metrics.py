"""Market metrics on the marts. The definitions are this project's own.

Listings are reduced to groups (months, places, sources) first; names and
indexes are joined to those groups. Medians are exact and never hold a group in
one task, see ``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import OWNER_DIRECT
from ..functions import month_key
from .keys import ranked
from .quantiles import described, exact_quantiles, exact_quantiles_of

RATIO = "precio_clp_por_m2"


def _dated(fact: DataFrame) -> DataFrame:
    """The fact with the month it was captured in and its price per square metre."""
    return fact.withColumns(
        {
            "_mes": F.trunc("fecha_scraping", "month"),
            RATIO: F.try_divide(F.col("precio_clp"), F.col("superficie_m2")),
        }
    )


def price_by_month(fact: DataFrame) -> DataFrame:
    figures = described(_dated(fact), ["_mes"], "precio_clp", {"mediana": 0.5}, {"n_avisos": F.lit(1)})
    return figures.select(
        month_key("_mes").alias("mes"), "n_avisos", F.col("media").alias("precio_promedio"),
        F.round("mediana", 2).alias("precio_mediano"),
    )


def place_price_growth(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Median price of a place's first and last year, and the change between them, ranked."""
    rows = fact.where(F.col("comuna_id").isNotNull()).select(
        "comuna_id", F.year("fecha_scraping").cast("bigint").alias("anio"), "precio_clp"
    )
    yearly = exact_quantiles(rows, ["comuna_id", "anio"], "precio_clp", {"mediana": 0.5})
    ends = yearly.groupBy("comuna_id").agg(
        F.min("anio").alias("primer_anio"), F.max("anio").alias("ultimo_anio"),
        F.min_by("mediana", "anio").alias("_a"), F.max_by("mediana", "anio").alias("_b"),
    )
    growth = ends.select(
        "comuna_id", "primer_anio", "ultimo_anio",
        F.round("_a", 2).alias("mediana_inicial"), F.round("_b", 2).alias("mediana_final"),
        F.round(F.try_divide(F.col("_b") - F.col("_a"), F.col("_a")) * 100, 4).alias(
            "variacion_pct"
        ),
    ).join(places, "comuna_id")
    in_region = Window.partitionBy("region").orderBy(F.desc("variacion_pct"))
    return ranked(growth, "puesto", "variacion_pct").withColumn(
        "puesto_en_region", F.rank().over(in_region).cast("bigint")
    ).orderBy(F.desc("variacion_pct"), "comuna_id")


def price_per_m2_by_month(fact: DataFrame) -> DataFrame:
    median = exact_quantiles(_dated(fact), ["_mes"], RATIO, {"m2_mediano": 0.5})
    return median.select(
        month_key("_mes").alias("mes"), F.round("m2_mediano", 4).alias("precio_m2_mediano")
    )


def supply_by_month(fact: DataFrame) -> DataFrame:
    """Distinct listings per month and source, and the change to the month before."""
    monthly = (
        _dated(fact).groupBy("_mes", "fuente").agg(F.count_distinct("id").alias("n_avisos"))
    )
    before = F.lag("n_avisos").over(Window.partitionBy("fuente").orderBy("_mes"))
    return monthly.withColumn("_antes", before).select(
        month_key("_mes").alias("mes"), "fuente", "n_avisos",
        (F.col("n_avisos") - F.col("_antes")).alias("cambio"),
        F.round(
            F.try_divide((F.col("n_avisos") - F.col("_antes")) * F.lit(100.0), F.col("_antes")), 4
        ).alias("cambio_pct"),
    )


def currency_index_by_month(fact: DataFrame) -> DataFrame:
    """Monthly medians in both currencies, first month = 100."""
    medians = exact_quantiles_of(
        _dated(fact), ["_mes"], {"clp": "precio_clp", "uf": "precio_uf_oficial"}, {"mediana": 0.5}
    )
    first = F.first("mediana").over(
        Window.partitionBy("metric").orderBy("_mes").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    return medians.select(
        month_key("_mes").alias("mes"), F.col("metric").alias("moneda"),
        F.round("mediana", 4).alias("mediana"),
        F.round(F.try_divide(F.col("mediana"), first) * 100, 4).alias("indice"),
    )


def place_figures(fact: DataFrame) -> DataFrame:
    """``comuna_id, n_avisos, n_dueno_directo, m2_mediano``: what the metrics of places share.

    One row per place; write it once and hand it to them, they don't read the fact for it.
    """
    rows = _dated(fact).where(F.col("comuna_id").isNotNull())
    sums = {"n_avisos": F.lit(1), "n_dueno_directo": F.when(F.col("contact_type") == OWNER_DIRECT, 1).otherwise(0)}
    figures = described(rows, ["comuna_id"], RATIO, {"m2_mediano": 0.5}, sums)
    return figures.select("comuna_id", *sums, "m2_mediano")


def place_attractiveness(figures: DataFrame, places: DataFrame) -> DataFrame:
    """Sum of z-scores over places: supply, owner share, median price per m2."""
    cells = figures.select(
        "comuna_id",
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("metric"), value.alias("x"))
                    for name, value in {
                        "oferta": F.col("n_avisos").cast("double"),
                        "dueno": F.try_divide(
                            F.col("n_dueno_directo").cast("double"), F.col("n_avisos")
                        ),
                        "m2": F.col("m2_mediano"),
                    }.items()
                )
            )
        ),
    )
    spread = cells.groupBy("metric").agg(F.avg("x").alias("_avg"), F.stddev_samp("x").alias("_dev"))
    z = F.try_divide(F.col("x") - F.col("_avg"), F.col("_dev"))
    scored = cells.join(spread, "metric").select("comuna_id", "metric", z.alias("z"))
    pick = {m: F.max(F.when(F.col("metric") == m, F.col("z"))) for m in ("oferta", "dueno", "m2")}
    return (
        scored.groupBy("comuna_id")
        .agg(
            *(F.round(c, 4).alias(f"z_{m}") for m, c in pick.items()),
            F.round(pick["oferta"] + pick["dueno"] + pick["m2"], 4).alias("atractivo"),
        )
        .join(places, "comuna_id")
        .orderBy(F.desc("atractivo"), "comuna_id")
    )


def owner_direct_concentration(figures: DataFrame, places: DataFrame) -> DataFrame:
    """Owner-direct listings per place: share inside the place and of all places."""
    everywhere = figures.agg(F.sum("n_dueno_directo")).scalar()
    owners = F.col("n_dueno_directo") * F.lit(100.0)
    return (
        figures.select(
            "comuna_id", "n_avisos", "n_dueno_directo",
            F.round(F.try_divide(owners, F.col("n_avisos")), 4).alias("pct_en_comuna"),
            F.round(F.try_divide(owners, everywhere), 4).alias("pct_del_total"),
        )
        .join(places, "comuna_id")
        .orderBy(F.desc("n_dueno_directo"), "comuna_id")
    )


def top_listings_to_contact(fact: DataFrame, figures: DataFrame, places: DataFrame, k: int = 5) -> DataFrame:
    """Owner-direct listings cheapest per m2 against their place's median, k per place.

    ``row_number() <= k`` prunes to k rows per place inside each map task, so a
    place with a third of all listings never reaches one task whole. ``figures`` is
    written, so the join to it is sized from its file; the fact is read once.
    """
    rows = _dated(fact).where(F.col("comuna_id").isNotNull())
    relative = F.try_divide(F.col(RATIO), F.col("m2_mediano"))
    order = [
        F.asc_nulls_last("relativo"), "fuente", "id", "precio_clp", "superficie_m2",
        "fecha_publicacion", "fecha_scraping",
    ]
    first = (
        rows.where(F.col("contact_type") == OWNER_DIRECT)
        .join(figures.select("comuna_id", "m2_mediano"), "comuna_id")
        .withColumn("relativo", relative)
        .withColumn(
            "puesto", F.row_number().over(Window.partitionBy("comuna_id").orderBy(*order))
        )
        .where(F.col("puesto") <= k)
    )
    return first.join(places, "comuna_id").select(
        "comuna", F.col("puesto").cast("bigint").alias("puesto"), "fuente", "id", "precio_clp",
        "superficie_m2", F.round("relativo", 6).alias("relativo"),
    )


def source_comparison(fact: DataFrame) -> DataFrame:
    """Listings, medians and owner share of each source, all from one histogram."""
    names = {"precio": "precio_mediano", "m2": "precio_m2_mediano", "superficie": "superficie_mediana"}
    cells = {"precio": F.col("precio_clp"), "m2": F.col(RATIO), "superficie": F.col("superficie_m2")}
    owner = F.when(F.col("contact_type") == OWNER_DIRECT, 1).otherwise(0)
    long = _dated(fact).select(
        "fuente", owner.alias("_o"),
        F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in cells.items()))),
    )
    figures = described(long, ["fuente", "metric"], "v", {"q": 0.5}, {"n_avisos": F.lit(1), "_o": F.col("_o")})
    one = F.col("metric") == "precio"  # each listing has one cell of each metric
    return figures.groupBy("fuente").agg(
        F.max(F.when(one, F.col("n_avisos"))).alias("n_avisos"),
        *(F.round(F.max(F.when(F.col("metric") == m, F.col("q"))), 4).alias(name) for m, name in names.items()),
        F.max(F.when(one, F.col("_o"))).alias("_o"),
    ).select(
        "fuente", "n_avisos", *names.values(),
        F.round(F.try_divide(F.col("_o") * F.lit(100.0), F.col("n_avisos")), 4).alias("pct_dueno_directo"),
    )
