"""Listing-like inputs from ``lineitem``, ``orders``, ``supplier``, ``nation``, ``region``.

Every line item becomes one raw listing: status F goes to the single-price source
``alpha``, status O to the dual-price source ``beta``. All raw values are strings,
as raw listing files have them. Line items of every hundredth part come twice, so
exact deduplication has work; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ListingRules, dual_price_source, single_price_source
from ..operators.metrics import place_figures
from ..operators.profile import collapsed
from ..operators.sketches import sketched
from ..plans.marts import (
    build_fact,
    build_place_dim,
    calendar_spanning,
    ratio_thresholds,
    usable_listings,
)
from ..plans.staging import stage_dual_price, stage_single_price, unify_sources
from ..plans.together import together
from ..sources.csv_tree import by_period
from ..sources.rates import typed_rates
from ..sources.workspace import Workspace, workspace_of

ALPHA = single_price_source("alpha")
BETA = dual_price_source("beta")
# l_quantity runs from 1 to 50, so the area sets lie inside that range
RULES = ListingRules(
    sentinels=(1.0, 2.0, 25.0, 40.0),
    rooms=(5.0, 8.0, 10.0, 12.0),
    suspects=(1.0, 2.0, 5.0, 25.0, 40.0),
    extreme_local=60_000.0,
    extreme_indexed=60.0,
)


def _text(c: Column) -> Column:
    return c.cast("string")


class Listings:
    """Inputs and layers of one data folder. Layers are written once and shared."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @property
    def workspace(self) -> Workspace:
        return workspace_of(self.spark)

    def _placed_items(self, status: str, periods: Callable[[Column], Column] | None) -> DataFrame:
        """Line items with their supplier's place, clustered by ``periodo`` if periods are wanted.

        One lookup after the other, each sized by Spark from its own file: small
        tables are broadcast, and a large supplier table costs one shuffle, where a
        hot supplier is split at run time.
        """
        items = self.table("lineitem").where(F.col("l_linestatus") == status)
        copies = F.when(F.col("l_partkey") % 100 == 0, 2).otherwise(1)
        items = items.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        if periods:  # a line item takes a third of the room its listing does
            day = F.col("l_shipdate").cast("date")
            items = by_period(items.withColumn("periodo", F.explode(periods(day))), "periodo")
        return (
            items.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        )

    def _raw(
        self, status: str, prefix: str, source: str, area: str, periods: Callable[[Column], Column] | None,
        **money: Column,
    ) -> DataFrame:
        upper = status == "O"
        name = F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit("  ")), F.lit(" "))
        captured = F.col("l_shipdate").cast("date")
        published = F.date_sub(captured, F.col("l_linenumber") * 7)
        even = F.col("l_partkey") % 2 == 0
        contact = F.when(F.col("l_suppkey") % 3 == 0, "owner_direct").otherwise("agency")
        if not upper:
            contact = F.when(F.col("l_suppkey") % 7 != 0, contact)
        return self._placed_items(status, periods).select(
            F.concat_ws("-", F.lit(prefix), "l_orderkey", "l_linenumber").alias("id"),
            F.lit(source).alias("fuente"),
            F.when(
                F.col("l_suppkey") % 25 != 0, F.upper(name) if upper else F.lower(name)
            ).alias("comuna"),
            F.col("r_name").alias("region"),
            *(c.alias(n) for n, c in money.items()),
            _text(F.col("l_quantity")).alias(area),
            F.concat(_text(published), F.lit("T00:00:00")).alias("fecha_publicacion"),
            _text(captured).alias("fecha_scraping"),
            F.when(even, "DEPARTAMENTO").otherwise("departamento").alias("tipo_propiedad"),
            F.when(even, "ARRIENDO").otherwise("arriendo").alias("tipo_operacion"),
            contact.alias("contact_type"),
            *(["periodo"] if periods else []),
        )

    def raw_of(self, name: str, periods: Callable[[Column], Column] | None = None) -> DataFrame:
        """Raw listings of a source; with ``periods`` (of a day: an array) one for each of them.

        Then they have a column ``periodo`` and are ready for ``write_csv_tree``, clustered.
        """
        return self._alpha(periods) if name == "alpha" else self._beta(periods)

    @property
    def raw_alpha(self) -> DataFrame:
        return self.raw_of("alpha")

    @property
    def raw_beta(self) -> DataFrame:
        return self.raw_of("beta")

    def _alpha(self, periods: Callable[[Column], Column] | None) -> DataFrame:
        currency = F.when(F.col("l_returnflag") == "A", "UF").when(
            F.col("l_returnflag") == "N", "CLP"
        )
        return self._raw(
            "F", "TA", "alpha", ALPHA.area, periods, precio=_text(F.col("l_extendedprice")), divisa=currency
        )

    def _beta(self, periods: Callable[[Column], Column] | None) -> DataFrame:
        price = F.col("l_extendedprice")
        return self._raw(
            "O", "PB", "beta", BETA.area, periods,
            precio_clp=_text(price), precio_uf=_text(F.when(F.col("l_tax") > 0, price / 1000)),
        )

    @property
    def raw_rates(self) -> DataFrame:
        """(fecha, valor): the day's dearest order; stamped in UTC like a landed series."""
        return (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("_dia"))
            .agg(F.max("o_totalprice").alias("_max"))
            .select(
                F.concat(_text(F.col("_dia")), F.lit(" 03:00:00+00:00")).alias("fecha"),
                (F.col("_max") / 100).alias("valor"),
            )
        )

    @property
    def payloads(self) -> DataFrame:
        """The series as landed JSON, one payload per year (at most 366 points each)."""
        point = F.struct("fecha", "valor")
        return self.raw_rates.groupBy(F.substring("fecha", 1, 4).alias("anio")).agg(
            F.to_json(F.struct(F.collect_list(point).alias("serie"))).alias("payload")
        )

    @property
    def faulty_payloads(self) -> DataFrame:
        """``archivo, payload``: the series as it might land, with all kinds of faults.

        By year: the payload, in which some days' points are faulty or come twice; the same
        cut off; one without the key; one with an empty series.
        """
        day = F.substring("fecha", 1, 10).cast("date")
        at = lambda d, rest: (F.dayofmonth(day) == d) & (F.month(day) % 4 == rest)
        made = lambda fecha, valor: F.concat(
            F.lit('{"fecha":"'), fecha, F.lit('","valor":'), valor, F.lit("}")
        )
        value = F.to_json(F.struct("valor"))
        number = F.regexp_extract(value, r':(.*)\}', 1)
        text = (
            F.when(at(13, 1), made(F.lit("sin fecha"), number)).when(at(17, 2), made(F.col("fecha"), F.lit("null")))
            .when(at(19, 3), made(F.col("fecha"), F.lit('"n/d"'))).otherwise(made(F.col("fecha"), number))
        )
        again = F.when(at(23, 0), F.array(text, made(F.col("fecha"), F.lit("1.0")))).otherwise(F.array(text))
        points = self.raw_rates.select("fecha", F.posexplode(again).alias("copia", "punto"))
        years = points.groupBy(F.substring("fecha", 1, 4).alias("anio")).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("fecha", "copia", "punto"))), lambda p: p.punto), ",").alias("lista")
        )
        whole = F.concat(F.lit('{"serie":['), "lista", F.lit("]}"))
        half = F.substr(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
        contents = {
            "": whole, "-cortado": half, "-vacio": F.lit('{"serie":[]}'),
            "-otra": F.concat(F.lit('{"series":['), "lista", F.lit("]}")),
        }
        files = F.array(
            *(F.struct(F.concat("anio", F.lit(end)).alias("archivo"), text.alias("payload")) for end, text in contents.items())
        )
        return years.select(F.inline(files))

    @cached_property
    def landed(self) -> str:
        """Folder with those payloads, one text file each."""
        path = self.workspace.path("payloads")
        files = self.faulty_payloads
        files.repartition(8, "archivo").write.partitionBy("archivo").text(path)
        return path

    # --- layers ----------------------------------------------------------------

    @cached_property
    def alpha_raw(self) -> DataFrame:
        """The raw table of ``alpha``: what profiles read again and again."""
        return self.workspace.keep(self.raw_alpha, "raw_alpha")

    @cached_property
    def beta_raw(self) -> DataFrame:
        return self.workspace.keep(self.raw_beta, "raw_beta")

    @cached_property
    def alpha_rows(self) -> DataFrame:
        """Distinct raw rows of ``alpha`` and how often each occurs: what copy profiles share."""
        return collapsed(self.alpha_raw, ALPHA.columns, self.workspace)

    @cached_property
    def beta_rows(self) -> DataFrame:
        return collapsed(self.beta_raw, BETA.columns, self.workspace)

    @cached_property
    def ratio_sketches(self) -> DataFrame:
        """One sketch of the price per square metre for each source and month."""
        usable = usable_listings(self.listings).withColumn("mes", F.trunc("fecha_scraping", "month"))
        return self.workspace.keep(sketched(usable, ["fuente", "mes"], "precio_clp_por_m2"), "bocetos")

    @cached_property
    def place_figures(self) -> DataFrame:
        return self.workspace.keep(place_figures(self.fact), "comunas")

    @cached_property
    def known_outliers(self) -> DataFrame:
        """Ids of listings beyond their source's threshold."""
        beyond = usable_listings(self.listings).join(self.thresholds, "fuente").where("precio_clp_por_m2 > umbral")
        return self.workspace.keep(beyond.select("fuente", "id").distinct(), "atipicos")

    @cached_property
    def rates(self) -> DataFrame:
        return self.workspace.keep(typed_rates(self.raw_rates), "rates")

    @cached_property
    def alpha(self) -> DataFrame:
        staged = stage_single_price(self.alpha_raw, self.rates, ALPHA, RULES)
        return self.workspace.keep(staged, "stg_alpha")

    @cached_property
    def beta(self) -> DataFrame:
        return self.workspace.keep(stage_dual_price(self.beta_raw, BETA, RULES), "stg_beta")

    @cached_property
    def listings(self) -> DataFrame:
        return unify_sources(*together(lambda: self.alpha, lambda: self.beta))

    @cached_property
    def places(self) -> DataFrame:
        return self.workspace.keep(build_place_dim(self.listings), "dim_comuna")

    @cached_property
    def calendar(self) -> DataFrame:
        days = calendar_spanning(self.listings, "fecha_publicacion", "fecha_scraping")
        return self.workspace.keep(days, "dim_calendario")

    @cached_property
    def thresholds(self) -> DataFrame:
        limits = ratio_thresholds(usable_listings(self.listings), RULES.tail_quantile)
        return self.workspace.keep(limits, "umbral")

    @cached_property
    def fact(self) -> DataFrame:
        self.listings  # the three below share it
        places, thresholds, _ = together(
            lambda: self.places, lambda: self.thresholds, lambda: self.calendar
        )
        fact = build_fact(self.listings, thresholds, places, self.rates)
        return self.workspace.keep(fact, "fct_arriendos")


INPUT_TABLES = ("lineitem", "orders", "supplier", "nation", "region")
_open: dict[tuple, Listings] = {}


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """Count and checksum of the inputs' files (path, length, last change).

    Layers of changed inputs are not reused. Spark lists the files, so a table may be a
    folder of any depth; contents are not read.
    """
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in INPUT_TABLES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count("*"), F.sum(mark)).first())


def listings(spark: SparkSession, folder: str) -> Listings:
    """The application's ``Listings`` of a folder; its layers are built on first use."""
    key = (spark.sparkContext.applicationId, folder, _stamp(spark, folder))
    if key not in _open:
        _open[key] = Listings(spark, folder)
    return _open[key]
