from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names shown in the calendar dimension, in calendar order.
# ``date_format`` is no substitute, its names follow the JVM locale.
MONTH_NAMES_ES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
    "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
WEEKDAY_NAMES_ES = [
    "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_iso_prefix(c: Column | str) -> Column:
    """Date of an ISO stamp by its first ten characters.

    Going through a timestamp would move the day in western session zones.
    """
    return F.substring(_col(c), 1, 10).cast("date")


def iso_weekday(c: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(c)) + 1).cast("bigint")


def is_weekend(c: Column | str) -> Column:
    return iso_weekday(c).isin(6, 7)


def month_name_es(c: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES_ES)), F.month(_col(c)))


def weekday_name_es(c: Column | str) -> Column:
    names = F.array(*map(F.lit, WEEKDAY_NAMES_ES))
    return F.element_at(names, F.weekday(_col(c)) + 1)


def month_key(c: Column | str) -> Column:
    """``yyyy-MM`` bucket of a date."""
    return F.date_format(_col(c), "yyyy-MM")
