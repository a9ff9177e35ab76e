"""Column expressions: text, dates, areas and money. All JVM side."""

from .areas import area_category, area_without_sentinels
from .dates import (
    date_from_iso_prefix,
    is_weekend,
    iso_weekday,
    month_key,
    month_name_es,
    weekday_name_es,
)
from .money import complete_currency, extreme_price, round_to_long
from .text import canonical_category, title_case_words, trimmed

__all__ = [
    "area_category", "area_without_sentinels", "canonical_category",
    "complete_currency", "date_from_iso_prefix", "extreme_price", "is_weekend",
    "iso_weekday", "month_key", "month_name_es", "round_to_long",
    "title_case_words", "trimmed", "weekday_name_es",
]
