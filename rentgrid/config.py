"""Rules and names of the listings engine, as plain frozen dataclasses.

Everything domain specific is a parameter here, so the same operators run on
real listing files and on any other listing-like table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- Fixed values: they decide the results and must not drift. ---------------
SENTINEL_AREAS = (1.0, 2.0, 250.0, 400.0, 650.0, 999.0, 1200.0)
ROOM_AREAS = (5.0, 8.0, 10.0, 12.0)
SUSPECT_AREAS = (1.0, 2.0, 5.0, 250.0, 400.0, 650.0, 999.0, 1200.0)
AREA_SENTINEL, AREA_ROOM, AREA_VALID = "centinela", "habitacion", "valida"
PROPERTY_LABELS = {"DEPARTAMENTO": "Departamento"}
OPERATION_LABELS = {"ARRIENDO": "Arriendo"}
LOCAL_CURRENCY, INDEXED_CURRENCY = "CLP", "UF"
EXTREME_LOCAL_PRICE, EXTREME_INDEXED_PRICE = 5_000_000.0, 100.0
OWNER_DIRECT = "owner_direct"
TAIL_QUANTILE = 0.99
YEAR_COVERAGE = 0.95
CALENDAR_START, CALENDAR_END = date(2022, 1, 1), date(2024, 12, 31)
EXPECTED_YEARS = (2023, 2024)
# -----------------------------------------------------------------------------

STAGING_COLUMNS = {
    "id": "string",
    "fuente": "string",
    "comuna": "string",
    "region": "string",
    "tipo_propiedad": "string",
    "tipo_operacion": "string",
    "contact_type": "string",
    "superficie_m2": "double",
    "superficie_m2_original": "double",
    "superficie_categoria": "string",
    "fecha_publicacion": "date",
    "fecha_scraping": "date",
    "precio_clp": "bigint",
    "precio_uf": "double",
    "precio_clp_es_calculado": "boolean",
    "precio_uf_es_calculado": "boolean",
    "valor_uf_referencia": "double",
}


@dataclass(frozen=True)
class ListingSource:
    """How one raw listing table spells price and area.

    A *single price* source has ``price`` + ``currency``; a *dual price* source
    has ``price_local`` + ``price_indexed``.
    """

    name: str
    area: str = "superficie_m2"
    price: str | None = None
    currency: str | None = None
    price_local: str | None = None
    price_indexed: str | None = None

    @property
    def is_single_price(self) -> bool:
        return self.price is not None

    @property
    def columns(self) -> list[str]:
        money = (
            [self.price, self.currency]
            if self.is_single_price
            else [self.price_local, self.price_indexed]
        )
        return [
            "id", "fuente", "comuna", "region", *money, self.area,
            "fecha_publicacion", "fecha_scraping",
            "tipo_propiedad", "tipo_operacion", "contact_type",
        ]


def single_price_source(name: str) -> ListingSource:
    return ListingSource(name, area="superficie_m2", price="precio", currency="divisa")


def dual_price_source(name: str) -> ListingSource:
    return ListingSource(
        name, area="superficie_total_m2",
        price_local="precio_clp", price_indexed="precio_uf",
    )


@dataclass(frozen=True)
class ListingRules:
    sentinels: tuple[float, ...] = SENTINEL_AREAS
    rooms: tuple[float, ...] = ROOM_AREAS
    suspects: tuple[float, ...] = SUSPECT_AREAS
    property_labels: dict[str, str] = field(default_factory=lambda: dict(PROPERTY_LABELS))
    operation_labels: dict[str, str] = field(default_factory=lambda: dict(OPERATION_LABELS))
    tail_quantile: float = TAIL_QUANTILE
    extreme_local: float = EXTREME_LOCAL_PRICE
    extreme_indexed: float = EXTREME_INDEXED_PRICE


@dataclass(frozen=True)
class Namespaces:
    raw: str = "raw"
    staging: str = "staging"
    marts: str = "marts"
    manifest: str = "manifest"


@dataclass(frozen=True)
class PipelineConfig:
    """One run: where raw files lie, where tables go, and which rules apply."""

    raw_root: str
    warehouse: str
    first: ListingSource
    second: ListingSource
    rate_name: str = "uf"
    expected_years: tuple[int, ...] = EXPECTED_YEARS
    calendar: tuple[date, date] = (CALENDAR_START, CALENDAR_END)
    rules: ListingRules = field(default_factory=ListingRules)
    namespaces: Namespaces = field(default_factory=Namespaces)
    # checks that may report rows without stopping the run
    tolerated: frozenset[str] = frozenset()
