"""raw -> staging -> marts in one run, checked before anything is published."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import PipelineConfig
from ..operators import quality as q
from ..sources.csv_tree import file_inventory, scan_csv_tree
from ..sources.rates import accepted, landed_points, read_payloads, refused, typed_rates, write_rate_csv
from ..sources.snapshots import RunTables
from ..sources.tables import overwrite_folder
from ..sources.workspace import Workspace
from .marts import (
    build_calendar_dim,
    build_fact,
    build_place_dim,
    ratio_thresholds,
    usable_listings,
)
from .staging import stage_dual_price, stage_single_price, unify_sources
from .together import together


@dataclass(frozen=True)
class Layers:
    """The tables of one run, read back from where they were written."""

    raw_first: DataFrame
    raw_second: DataFrame
    rates: DataFrame
    first: DataFrame
    second: DataFrame
    listings: DataFrame
    places: DataFrame
    calendar: DataFrame
    fact: DataFrame


def build_layers(
    raw_first: DataFrame, raw_second: DataFrame, rates: DataFrame,
    config: PipelineConfig, tables: RunTables, workspace: Workspace,
) -> Layers:
    """Staging and marts from raw tables; every table is written once.

    ``rates`` is typed and written already, so its join is sized from its file.
    The union of the sources is published as a view: copying both sources once
    more would only double the staging layer.
    """
    spark, ns = raw_first.sparkSession, config.namespaces
    first, second = together(
        lambda: tables.write(
            stage_single_price(raw_first, rates, config.first, config.rules),
            ns.staging, f"stg_{config.first.name}",
        ),
        lambda: tables.write(
            stage_dual_price(raw_second, config.second, config.rules),
            ns.staging, f"stg_{config.second.name}",
        ),
    )
    listings = unify_sources(first, second)
    tables.union_view(
        ns.staging, "stg_arriendos", [f"stg_{s.name}" for s in (config.first, config.second)]
    )
    q.enforce(
        q.report(
            q.tables_non_empty(
                {f"stg_{config.first.name}": first, f"stg_{config.second.name}": second,
                 "stg_arriendos": listings}
            ),
            q.union_row_conservation([first, second], listings),
            q.rate_date_unique(rates),
        ),
        config.tolerated,
    )
    places, calendar, thresholds = together(
        lambda: tables.write(build_place_dim(listings), ns.marts, "dim_comuna"),
        lambda: tables.write(
            build_calendar_dim(spark, *config.calendar), ns.marts, "dim_calendario"
        ),
        lambda: workspace.keep(
            ratio_thresholds(usable_listings(listings), config.rules.tail_quantile), "umbral"
        ),
    )
    fact = tables.write(
        build_fact(listings, thresholds, places, rates), ns.marts, "fct_arriendos"
    )
    q.enforce(
        q.report(
            q.tables_non_empty(
                {"dim_comuna": places, "dim_calendario": calendar, "fct_arriendos": fact}
            ),
            q.fact_not_larger(fact, listings),
            q.no_null_prices(fact),
        ),
        config.tolerated,
    )
    return Layers(raw_first, raw_second, rates, first, second, listings, places, calendar, fact)


def land_rate_series(
    spark: SparkSession, payload_folder: str, csv_folder: str, years: tuple[int, ...],
    tolerated: frozenset[str] = frozenset(), quarantine: str | None = None, pattern: str = "*.json",
) -> DataFrame:
    """Landed yearly payloads -> one checked series, sorted by day, as raw CSV.

    A faulty point or payload stops the landing. With a ``quarantine`` folder it is put
    there instead, with its reason, and the others land; then only the coverage of
    ``years`` may stop it, and the faulty rows are there to be looked at.
    """
    with Workspace(spark) as workspace:
        points = workspace.keep(landed_points(read_payloads(spark, payload_folder, pattern)), "points")
        if quarantine is None:
            q.enforce(q.report(q.landed_quality(points)), tolerated)
        else:
            overwrite_folder(refused(points), quarantine)
        series = accepted(points)
        q.enforce(q.report(q.year_coverage_check(typed_rates(series), years)), tolerated)
        write_rate_csv(series, csv_folder)
    return spark.read.schema(series.schema).option("header", True).csv(csv_folder)


def run(spark: SparkSession, config: PipelineConfig) -> Layers:
    """CSV trees below ``raw_root`` -> published tables of all three layers, in one step.

    A run that fails leaves the last published tables as they were and removes its own.
    """
    folders = {s.name: f"{config.raw_root}/{s.name}" for s in (config.first, config.second)}
    missing = file_inventory(spark, folders, config.expected_years)
    q.enforce(q.report(q.file_inventory_check(missing)), config.tolerated)

    with RunTables(spark, config.warehouse, config.namespaces.manifest) as tables, Workspace(spark) as workspace:

        def load(name: str, columns: list[str]) -> DataFrame:
            raw = scan_csv_tree(spark, f"{config.raw_root}/{name}", columns)
            return tables.write(raw.select(*columns), config.namespaces.raw, name)

        raw_first, raw_second, raw_rates = together(
            lambda: load(config.first.name, config.first.columns),
            lambda: load(config.second.name, config.second.columns),
            lambda: load(config.rate_name, ["fecha", "valor"]),
        )
        rates = tables.write(typed_rates(raw_rates), config.namespaces.staging, f"stg_{config.rate_name}")
        q.enforce(
            q.report(
                q.tables_non_empty({config.first.name: raw_first, config.second.name: raw_second}),
                q.year_coverage_check(rates, config.expected_years),
            ),
            config.tolerated,
        )
        layers = build_layers(raw_first, raw_second, rates, config, tables, workspace)
        tables.publish()
        return layers
