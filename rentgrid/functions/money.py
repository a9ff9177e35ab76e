from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import INDEXED_CURRENCY, LOCAL_CURRENCY


def round_to_long(c: Column) -> Column:
    """Half away from zero, then integer. Casting first would truncate."""
    return F.round(c).cast("bigint")


def complete_currency(
    price: Column,
    currency: Column,
    rate: Column,
    *,
    local: str = LOCAL_CURRENCY,
    indexed: str = INDEXED_CURRENCY,
) -> dict[str, Column]:
    """Both prices of a one-price row, which one was derived, and the rate used.

    A currency that is neither leaves both prices NULL. The two flags are the
    comparisons themselves, so a NULL currency gives NULL flags.
    """
    is_local, is_indexed = currency == local, currency == indexed
    return {
        "precio_clp": F.when(is_local, round_to_long(price)).when(
            is_indexed, round_to_long(price * rate)
        ),
        "precio_uf": F.when(is_indexed, price).when(is_local, F.round(price / rate, 2)),
        "precio_clp_es_calculado": is_indexed,
        "precio_uf_es_calculado": is_local,
        "valor_uf_referencia": rate,
    }


def extreme_price(
    local_price: Column, indexed_price: Column, local_limit: float, indexed_limit: float
) -> Column:
    """True when either currency is beyond its limit."""
    return (local_price > local_limit) | (indexed_price > indexed_limit)
