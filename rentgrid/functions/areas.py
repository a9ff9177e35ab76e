from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AREA_ROOM, AREA_SENTINEL, AREA_VALID


def area_category(area: Column, sentinels: Sequence[float], rooms: Sequence[float]) -> Column:
    """Sentinel, room, or (everything else, NULL included) valid."""
    return (
        F.when(area.isin(list(sentinels)), AREA_SENTINEL)
        .when(area.isin(list(rooms)), AREA_ROOM)
        .otherwise(AREA_VALID)
    )


def area_without_sentinels(area: Column, sentinels: Sequence[float]) -> Column:
    """NULL for placeholder areas. ``~isin`` would also be NULL for NULL, same result."""
    return F.when(~area.isin(list(sentinels)), area)
