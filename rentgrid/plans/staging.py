"""Raw -> staging: exact dedup, typing, normalisation, currency completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STAGING_COLUMNS, ListingRules, ListingSource
from ..functions import (
    area_category,
    area_without_sentinels,
    canonical_category,
    complete_currency,
    date_from_iso_prefix,
    round_to_long,
    title_case_words,
)
from ..sources.workspace import spread


def distinct_raw(raw: DataFrame, source: ListingSource) -> DataFrame:
    """Exact copies collapse (NULLs equal), a bounded number of rows at a time."""
    # fuente is one value: Spark may fold it, and would then shuffle again to group by the rest
    keys = [c for c in source.columns if c != "fuente"]
    return spread(raw.select(*source.columns), keys).distinct()


def _normalised(source: ListingSource, rules: ListingRules) -> dict[str, Column]:
    area = F.col(source.area).cast("double")
    return {
        "id": F.col("id"),
        "fuente": F.col("fuente"),
        "comuna": title_case_words("comuna"),
        "region": F.col("region"),
        "tipo_propiedad": canonical_category("tipo_propiedad", rules.property_labels),
        "tipo_operacion": canonical_category("tipo_operacion", rules.operation_labels),
        "contact_type": F.col("contact_type"),
        "superficie_m2": area_without_sentinels(area, rules.sentinels),
        "superficie_m2_original": area,
        "superficie_categoria": area_category(area, rules.sentinels, rules.rooms),
        "fecha_publicacion": date_from_iso_prefix("fecha_publicacion"),
        "fecha_scraping": date_from_iso_prefix("fecha_scraping"),
    }


def _as_staging(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*(columns[c].cast(t).alias(c) for c, t in STAGING_COLUMNS.items()))


def stage_single_price(
    raw: DataFrame, rates: DataFrame, source: ListingSource, rules: ListingRules
) -> DataFrame:
    """One price and its currency; the other currency comes from the day's rate."""
    listings = distinct_raw(raw, source).withColumn(
        "_dia", date_from_iso_prefix("fecha_scraping")
    )
    rated = listings.join(rates, listings["_dia"] == rates["fecha_dt"], "left")
    money = complete_currency(
        F.col(source.price).cast("double"), F.col(source.currency), F.col("valor_uf")
    )
    return _as_staging(rated, {**_normalised(source, rules), **money})


def stage_dual_price(raw: DataFrame, source: ListingSource, rules: ListingRules) -> DataFrame:
    """Both prices are native; a missing indexed price stays missing."""
    money = {
        "precio_clp": round_to_long(F.col(source.price_local).cast("double")),
        "precio_uf": F.col(source.price_indexed).cast("double"),
        "precio_clp_es_calculado": F.lit(False),
        "precio_uf_es_calculado": F.lit(False),
        "valor_uf_referencia": F.lit(None),
    }
    return _as_staging(distinct_raw(raw, source), {**_normalised(source, rules), **money})


def assert_staging_schema(df: DataFrame) -> DataFrame:
    found = dict(df.dtypes)
    if found != STAGING_COLUMNS:
        raise TypeError(f"not a staging table: {found}")
    return df


def unify_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL; ``fuente`` tells the rows apart."""
    return assert_staging_schema(first).unionByName(assert_staging_schema(second))
