"""Registered queries on the binding, each with the same result in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Namespaces, PipelineConfig
from ..functions import canonical_category, extreme_price, title_case_words
from ..operators import anomalies as an
from ..operators import metrics as mt
from ..operators import profile as pf
from ..operators import quality as q
from ..operators.quantiles import approx_quantiles, exact_quantiles
from ..operators.sketches import measured_ranks, merged, rank_error, sketch_quantiles
from ..plans.marts import below_threshold, build_calendar_dim, ratio_thresholds, usable_listings
from ..plans.pipeline import land_rate_series, run
from ..sources.csv_tree import (
    list_files, missing_periods, period_of_path, scan_csv_tree, with_source_file, write_csv_tree,
)
from ..sources.rates import (
    flatten_payloads, landed_points, read_payloads, refused, typed_rates, write_rate_csv,
)
from ..sources.tables import loaded_row_count, overwrite_folder
from .listings import ALPHA, BETA, RULES, Listings, listings
from .oracle import with_blocks

Query = Callable[[Listings], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, sql: str | None):
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = with_blocks(sql)
            return fn

        return register


REGISTRY = Registry()
query = REGISTRY.add

STAGING = (
    "id, fuente, comuna, region, tipo_propiedad, tipo_operacion, contact_type, superficie_m2, "
    "superficie_m2_original, superficie_categoria, fecha_publicacion, fecha_scraping, precio_clp, "
    "precio_uf, precio_clp_es_calculado, precio_uf_es_calculado, valor_uf_referencia"
)
FACT = (
    "id, fuente, comuna_id, contact_type, superficie_m2, fecha_publicacion, fecha_scraping, "
    "precio_clp, precio_uf_oficial"
)


def both(x: Listings, fn: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """``fn`` on each raw source (rows, area column, source name), results together."""
    parts = [
        fn(raw, area, name).withColumn("fuente", F.lit(name))
        for raw, area, name in (
            (x.alpha_raw, ALPHA.area, "alpha"), (x.beta_raw, BETA.area, "beta"),
        )
    ]
    return parts[0].unionByName(parts[1])


SOURCES = {"alpha": ALPHA, "beta": BETA}
PRICES = {"alpha": ["precio"], "beta": ["precio_clp", "precio_uf"]}


def both_sql(make: Callable[[str], str]) -> str:
    """The same over the SQL of each raw source."""
    return " UNION ALL ".join(f"(SELECT '{name}' AS fuente, * FROM ({make(name)}))" for name in SOURCES)


# --- models ---------------------------------------------------------------------


@query("""
    SELECT u.id, u.fuente, u.superficie_m2, u.fecha_scraping, u.precio_clp, u.precio_clp_por_m2
    FROM usable u JOIN limits USING (fuente) WHERE precio_clp_por_m2 <= umbral""")
def usable_listings_core(x: Listings) -> DataFrame:
    usable = usable_listings(x.listings)
    limits = x.workspace.keep(ratio_thresholds(usable, RULES.tail_quantile), "umbral")
    return below_threshold(usable, limits).select(
        "id", "fuente", "superficie_m2", "fecha_scraping", "precio_clp", "precio_clp_por_m2"
    )


@query(f"SELECT {STAGING} FROM listings WHERE fuente = 'alpha'")
def staging_single_price(x: Listings) -> DataFrame:
    return x.alpha


@query(f"SELECT {STAGING} FROM listings WHERE fuente = 'beta'")
def staging_dual_price(x: Listings) -> DataFrame:
    return x.beta


@query(f"SELECT {STAGING} FROM listings")
def staging_union(x: Listings) -> DataFrame:
    return x.listings


@query("""
    SELECT l.comuna, count(*) AS n, count(DISTINCT l.cruda) AS n_formas FROM (
      SELECT comuna AS cruda, array_to_string(list_transform(
               list_filter(string_split(lower(trim(comuna)), ' '), lambda w: w <> ''),
               lambda w: upper(w[1:1]) || w[2:]), ' ') AS comuna FROM raw_both) l
    GROUP BY l.comuna""")
def title_case_places(x: Listings) -> DataFrame:
    raw = x.alpha_raw.select("comuna").unionByName(x.beta_raw.select("comuna"))
    return raw.groupBy(title_case_words("comuna").alias("comuna")).agg(
        F.count("*").alias("n"), F.count_distinct(F.col("comuna")).alias("n_formas")
    )


@query("""
    SELECT fuente, 'Departamento' AS tipo_propiedad, 'Arriendo' AS tipo_operacion,
           count(*) AS n, count(DISTINCT tipo_propiedad) AS n_formas
    FROM raw_both
    WHERE upper(trim(tipo_propiedad)) = 'DEPARTAMENTO' AND upper(trim(tipo_operacion)) = 'ARRIENDO'
    GROUP BY fuente""")
def canonical_categories(x: Listings) -> DataFrame:
    raw = x.alpha_raw.select("fuente", "tipo_propiedad", "tipo_operacion").unionByName(
        x.beta_raw.select("fuente", "tipo_propiedad", "tipo_operacion")
    )
    return (
        raw.withColumn("_forma", F.col("tipo_propiedad"))
        .withColumns(
            {
                "tipo_propiedad": canonical_category("tipo_propiedad", RULES.property_labels),
                "tipo_operacion": canonical_category("tipo_operacion", RULES.operation_labels),
            }
        )
        .groupBy("fuente", "tipo_propiedad", "tipo_operacion")
        .agg(F.count("*").alias("n"), F.count_distinct("_forma").alias("n_formas"))
    )


@query("SELECT comuna_id, comuna, region FROM places")
def place_dimension(x: Listings) -> DataFrame:
    return x.places


@query("SELECT * FROM calendar")
def calendar_dimension(x: Listings) -> DataFrame:
    return x.calendar


@query(f"SELECT {FACT} FROM fact")
def usable_listings_fact(x: Listings) -> DataFrame:
    return x.fact


@query("""
    SELECT fuente, round(umbral, 6) AS umbral, count(*) AS n_con_razon,
           count(*) FILTER (WHERE m2 > umbral) AS n_sobre
    FROM (SELECT fuente, precio_clp_por_m2 AS m2,
                 quantile_cont(precio_clp_por_m2, 0.99) OVER (PARTITION BY fuente) AS umbral
          FROM usable) WHERE m2 IS NOT NULL GROUP BY fuente, umbral""")
def percentile_threshold_window(x: Listings) -> DataFrame:
    usable = usable_listings(x.listings).select("fuente", "precio_clp_por_m2")
    limits = x.workspace.keep(ratio_thresholds(usable, RULES.tail_quantile), "umbral")
    ratio = F.col("precio_clp_por_m2")
    return (
        usable.join(limits, "fuente")
        .groupBy("fuente", "umbral")
        .agg(
            F.count(ratio).alias("n_con_razon"),
            F.count_if(ratio > F.col("umbral")).alias("n_sobre"),
        )
        .withColumn("umbral", F.round("umbral", 6))
    )


@query("SELECT fecha_dt, valor_uf FROM rates")
def rate_series_from_payload(x: Listings) -> DataFrame:
    return typed_rates(flatten_payloads(x.payloads))


# --- sources, sinks, pipeline -----------------------------------------------------


def raw_tree(x: Listings) -> str:
    """Raw CSV trees of the binding, one folder per source and month; written once."""
    if "_tree" not in x.__dict__:
        root = x.workspace.path("raw")
        for name in SOURCES:
            rows = x.raw_of(name, lambda day: F.array(F.substring(day.cast("string"), 1, 7)))
            write_csv_tree(rows, f"{root}/{name}", "periodo", clustered=True, compression="gzip")
        write_rate_csv(x.raw_rates, f"{root}/uf")
        x.__dict__["_tree"] = root
    return x.__dict__["_tree"]


@query("""
    SELECT fuente, strftime(fecha_scraping, '%Y-%m') AS periodo_archivo, count(*) AS n,
           count(DISTINCT id) AS n_ids, max(monto) AS precio_maximo,
           CAST(sum(length(comuna)) AS BIGINT) AS largo_comuna
    FROM raw_both GROUP BY 1, 2""")
def csv_tree_roundtrip(x: Listings) -> DataFrame:
    def figures(_raw: DataFrame, _area: str, name: str) -> DataFrame:
        rows = with_source_file(scan_csv_tree(x.spark, f"{raw_tree(x)}/{name}", SOURCES[name].columns))
        return rows.groupBy("periodo_archivo").agg(
            F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"),
            F.max(pf.number(PRICES[name][0])).alias("precio_maximo"),
            F.sum(F.length("comuna")).alias("largo_comuna"),
        )

    return both(x, figures)


@query("""
    SELECT fuente, strftime(fecha_scraping, '%Y-%m') AS periodo_archivo, count(*) AS n
    FROM raw_both GROUP BY 1, 2""")
def rows_per_file(x: Listings) -> DataFrame:
    def counts(source, name: str) -> DataFrame:
        rows = with_source_file(scan_csv_tree(x.spark, f"{raw_tree(x)}/{name}", source.columns))
        return pf.rows_per_file(rows, "periodo_archivo").withColumn("fuente", F.lit(name))

    return counts(ALPHA, "alpha").unionByName(counts(BETA, "beta"))


@query("""
    SELECT 'raw_' || fuente AS tabla, count(*) AS n, count(*) AS n_otra_vez
    FROM raw_both GROUP BY fuente""")
def overwrite_idempotent(x: Listings) -> DataFrame:
    def twice(raw: DataFrame, _area: str, name: str) -> DataFrame:
        path = x.workspace.path("overwrite")
        first = loaded_row_count(overwrite_folder(raw, path))
        return overwrite_folder(raw, path).agg(F.count("*").alias("n_otra_vez")).select(
            F.lit(f"raw_{name}").alias("tabla"), F.lit(first).cast("bigint").alias("n"), "n_otra_vez"
        )

    return both(x, twice).drop("fuente")


@query("""
    SELECT fuente, periodo FROM (
      SELECT unnest(['alpha', 'beta']) AS fuente, periodo FROM (
        SELECT strftime(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
                                               INTERVAL 1 MONTH)), '%Y-%m') AS periodo))
    EXCEPT SELECT DISTINCT fuente, strftime(fecha_scraping, '%Y-%m') FROM raw_both""")
def file_inventory(x: Listings) -> DataFrame:
    present = None
    for name in ("alpha", "beta"):
        files = list_files(x.spark, f"{raw_tree(x)}/{name}").select(
            F.lit(name).alias("fuente"), period_of_path(F.col("path")).alias("periodo")
        )
        present = files if present is None else present.unionByName(files)
    return missing_periods(present, ["alpha", "beta"], range(1995, 2002))


@query("""
    SELECT fuente, count(*) AS n, count(*) FILTER (WHERE comuna_id IS NULL) AS n_sin_comuna,
           count(*) FILTER (WHERE precio_uf_oficial IS NULL) AS n_sin_uf,
           CAST(sum(precio_clp) AS BIGINT) AS suma_clp
    FROM fact GROUP BY fuente""")
def pipeline_run(x: Listings) -> DataFrame:
    """CSV files to published marts in one call; leaves no names in the catalog."""
    suffix = uuid.uuid4().hex[:12]  # no database of anyone else has this name
    names = Namespaces(*(f"rentgrid_{layer}_{suffix}" for layer in ("raw", "staging", "marts", "manifest")))
    config = PipelineConfig(
        raw_root=raw_tree(x), warehouse=x.workspace.path("warehouse"), first=ALPHA, second=BETA,
        expected_years=tuple(range(1995, 2002)), rules=RULES,
        namespaces=names,
        # at every scale orders end in August 2001 and listings in November, so the last year
        # lacks rates and its last files (``file_inventory`` names them); at small scales
        # single days have no order, hence no rate
        tolerated=frozenset(
            {"no_null_prices:precio_uf_oficial", "year_coverage", "file_inventory_complete"}
        ),
    )
    try:
        run(x.spark, config)
        published = x.spark.table(f"{names.marts}.fct_arriendos")  # through the manifest, as any reader
        fact = x.workspace.keep(published.select("fuente", "comuna_id", "precio_clp", "precio_uf_oficial"), "published")
    finally:
        for name in (names.marts, names.staging, names.raw, names.manifest):
            x.spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return fact.groupBy("fuente").agg(
        F.count("*").alias("n"), F.count_if(F.col("comuna_id").isNull()).alias("n_sin_comuna"),
        F.count_if(F.col("precio_uf_oficial").isNull()).alias("n_sin_uf"),
        F.sum("precio_clp").alias("suma_clp"),
    )


# --- checks -------------------------------------------------------------------------


@query("""
    SELECT CAST(extract(year FROM fecha_dt) AS BIGINT) AS anio, count(*) AS n_dias,
           CAST(CASE WHEN extract(year FROM fecha_dt) % 4 = 0 THEN 366 ELSE 365 END AS BIGINT)
             AS dias_esperados,
           count(*) >= 0.95 * CASE WHEN extract(year FROM fecha_dt) % 4 = 0 THEN 366 ELSE 365 END
             AS ok
    FROM rates GROUP BY extract(year FROM fecha_dt)""")
def year_coverage(x: Listings) -> DataFrame:
    return q.year_coverage(x.rates)


@query("""
    SELECT check_name, n_bad, n_bad = 0 AS ok FROM (
      SELECT unnest(['payload_without_series', 'payload_bad_date', 'payload_null_value']) AS check_name,
             unnest([(SELECT 3 * count(DISTINCT anio) FROM landed),
                     (SELECT count(*) FROM landed WHERE motivo = 'fecha_invalida'),
                     (SELECT count(*) FROM landed WHERE motivo IN ('valor_nulo', 'valor_invalido'))]) AS n_bad)""")
def payload_quality(x: Listings) -> DataFrame:
    return q.report(q.payload_quality(x.faulty_payloads))


@query("SELECT fecha_dt, valor_uf FROM landed WHERE motivo IS NULL")
def landed_rate_series(x: Listings) -> DataFrame:
    """JSON files as they might land -> checks and quarantine -> CSV -> typed series."""
    folder = x.workspace.path("uf")
    # at small scales single days have no order, and the last year is short at all scales
    years = tuple(range(1995, 2002))
    land_rate_series(
        x.spark, x.landed, folder, years, frozenset({"year_coverage"}), x.workspace.path("cuarentena"), "*.txt"
    )
    return typed_rates(x.spark.read.option("header", True).csv(folder))


@query("""
    SELECT anio AS archivo, motivo, count(*) AS n, CAST(0 AS BIGINT) AS n_con_contenido FROM landed
    WHERE motivo IS NOT NULL GROUP BY ALL
    UNION ALL SELECT anio, 'fecha_repetida', count(*), 0 FROM landed WHERE dos_veces GROUP BY ALL
    UNION ALL SELECT DISTINCT anio || ende, motivo, 1, 1 FROM (SELECT DISTINCT anio FROM landed),
      (VALUES ('-cortado', 'json_invalido'), ('-otra', 'sin_serie'), ('-vacio', 'serie_vacia')) v(ende, motivo)""")
def payload_quarantine(x: Listings) -> DataFrame:
    """What the landing refuses, by file and reason."""
    points = landed_points(read_payloads(x.spark, x.landed, "*.txt"))
    kept = overwrite_folder(refused(points), x.workspace.path("cuarentena"))
    file = F.regexp_extract("archivo", "archivo=([^/]+)/", 1)
    return kept.groupBy(file.alias("archivo"), "motivo").agg(
        F.count("*").alias("n"), F.count("contenido").alias("n_con_contenido")
    )


@query("""
    SELECT check_name, CAST(n_bad AS BIGINT) AS n_bad, n_bad = 0 AS ok FROM (
      SELECT 'tables_non_empty:stg_alpha' AS check_name,
             CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n_bad FROM listings WHERE fuente = 'alpha'
      UNION ALL SELECT 'tables_non_empty:stg_beta', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END
        FROM listings WHERE fuente = 'beta'
      UNION ALL SELECT 'tables_non_empty:fct_arriendos', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END
        FROM fact
      UNION ALL SELECT 'union_row_conservation', abs((SELECT count(*) FROM listings)
        - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_both)))
      UNION ALL SELECT 'fact_not_larger',
        greatest((SELECT count(*) FROM fact) - (SELECT count(*) FROM listings), 0)
      UNION ALL SELECT 'no_null_prices:precio_clp',
        count(*) FILTER (WHERE precio_clp IS NULL) FROM fact
      UNION ALL SELECT 'no_null_prices:precio_uf_oficial',
        count(*) FILTER (WHERE precio_uf_oficial IS NULL) FROM fact
      UNION ALL SELECT 'sentinel_with_area', count(*) FILTER (
        WHERE superficie_categoria = 'centinela' AND superficie_m2 IS NOT NULL) FROM listings
      UNION ALL SELECT 'room_without_area', count(*) FILTER (
        WHERE superficie_categoria = 'habitacion' AND superficie_m2 IS NULL) FROM listings
      UNION ALL SELECT 'sentinel_without_price', count(*) FILTER (
        WHERE superficie_categoria = 'centinela' AND precio_clp IS NULL) FROM listings
      UNION ALL SELECT 'dedup_conservation:alpha',
        abs((SELECT count(*) FROM listings WHERE fuente = 'alpha')
            - (SELECT count(DISTINCT id) FROM raw_alpha))
      UNION ALL SELECT 'dedup_conservation:beta',
        abs((SELECT count(*) FROM listings WHERE fuente = 'beta')
            - (SELECT count(DISTINCT id) FROM raw_beta))
      UNION ALL SELECT 'dimension_key_unique', count(*) - count(DISTINCT comuna_id) FROM places
      UNION ALL SELECT 'rate_date_unique', count(*) - count(DISTINCT fecha_dt) FROM rates
      UNION ALL SELECT 'one_region_per_place', count(*) FROM (
        SELECT comuna FROM listings WHERE comuna IS NOT NULL
        GROUP BY comuna HAVING count(DISTINCT region) > 1))""")
def pipeline_checks(x: Listings) -> DataFrame:
    return q.report(
        q.tables_non_empty(
            {"stg_alpha": x.alpha, "stg_beta": x.beta, "fct_arriendos": x.fact}
        ),
        q.union_row_conservation([x.alpha, x.beta], x.listings),
        q.fact_not_larger(x.fact, x.listings),
        q.no_null_prices(x.fact),
        q.sentinel_consistency(x.listings),
        q.dedup_conservation(x.alpha_raw, x.alpha, name="alpha"),
        q.dedup_conservation(x.beta_raw, x.beta, name="beta"),
        q.dimension_key_unique(x.places, "comuna_id"),
        q.rate_date_unique(x.rates),
        q.one_region_per_place(x.listings),
    )


@query("""
    SELECT count(*) AS n_filas, count(DISTINCT comuna_id) AS n_ids_distintos,
           count(DISTINCT region) AS n_regiones FROM places""")
def dimension_summary(x: Listings) -> DataFrame:
    return q.dimension_summary(x.places, "comuna_id", "region")


@query("""
    SELECT dia_semana, nombre_dia, es_fin_de_semana, count(*) AS n FROM calendar
    GROUP BY dia_semana, nombre_dia, es_fin_de_semana""")
def calendar_weekdays(x: Listings) -> DataFrame:
    return q.weekday_convention(x.calendar)


@query("""
    SELECT count(*) AS n_dias, min(fecha) AS min_fecha, max(fecha) AS max_fecha FROM calendar""")
def calendar_summary(x: Listings) -> DataFrame:
    return q.calendar_summary(x.calendar)


@query("""
    SELECT 'calendar_covers:fecha_scraping' AS check_name, count(*) AS n_bad, count(*) = 0 AS ok
    FROM fact LEFT JOIN calendar ON fecha = fecha_scraping WHERE fecha IS NULL
    UNION ALL
    SELECT 'calendar_covers:fecha_publicacion', count(*), count(*) = 0
    FROM fact LEFT JOIN calendar ON fecha = fecha_publicacion WHERE fecha IS NULL""")
def calendar_coverage(x: Listings) -> DataFrame:
    return q.report(
        q.calendar_covers(x.fact, x.calendar, "fecha_scraping"),
        q.calendar_covers(x.fact, x.calendar, "fecha_publicacion"),
    )


@query("""
    SELECT fuente, count(*) AS n, round(max(m2), 0) AS max_precio_por_m2 FROM dated GROUP BY fuente""")
def fact_tail_by_source(x: Listings) -> DataFrame:
    return q.fact_tail_by_source(x.fact)


@query("""
    SELECT count(*) AS n_atipicos, count(*) FILTER (WHERE EXISTS (
             SELECT 1 FROM fact f WHERE f.fuente = u.fuente AND f.id = u.id
               AND f.precio_clp = u.precio_clp AND f.superficie_m2 = u.superficie_m2
               AND f.fecha_scraping = u.fecha_scraping
               AND f.fecha_publicacion = u.fecha_publicacion)) AS n_en_hechos
    FROM usable u JOIN limits USING (fuente) WHERE u.precio_clp_por_m2 > umbral""")
def outliers_absent(x: Listings) -> DataFrame:
    return q.outliers_absent(usable_listings(x.listings), x.thresholds, x.fact)


@query("""
    SELECT k.fuente, count(*) AS n_ids, count(f.n) AS n_ids_presentes, CAST(coalesce(sum(f.n), 0) AS BIGINT) AS n_filas
    FROM (SELECT DISTINCT fuente, id FROM usable JOIN limits USING (fuente) WHERE precio_clp_por_m2 > umbral) k
    LEFT JOIN (SELECT fuente, id, count(*) AS n FROM fact GROUP BY ALL) f USING (fuente, id) GROUP BY 1""")
def known_ids_absent(x: Listings) -> DataFrame:
    """Known outliers in the fact. Ids repeat here, so some come in with another row."""
    return q.known_presence(x.fact, x.known_outliers)


@query("""
    SELECT CAST(d AS DATE) AS fecha, CAST(isodow(d) AS BIGINT) AS dia_semana, strftime(d, '%Y') || '-T' || quarter(d) AS periodo,
           count(f.id) AS n_avisos
    FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)
    LEFT JOIN fact f ON f.fecha_scraping = d GROUP BY d""")
def calendar_configured(x: Listings) -> DataFrame:
    """The calendar of a configured range, each day with its listings, none included."""
    days = build_calendar_dim(x.spark, date(1995, 1, 1), date(2001, 12, 31))
    listed = x.fact.groupBy("fecha_scraping").agg(F.count("*").alias("n"))
    return days.join(listed, F.col("fecha") == F.col("fecha_scraping"), "left").select(
        "fecha", "dia_semana", F.concat_ws("-T", F.col("anio"), F.col("trimestre")).alias("periodo"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_avisos"),
    )


@query("""
    SELECT fuente, count(*) AS total,
           count(*) FILTER (WHERE superficie_categoria = 'centinela') AS excluido_centinela,
           count(*) FILTER (WHERE superficie_categoria = 'habitacion') AS excluido_habitacion,
           count(*) FILTER (WHERE superficie_categoria <> 'valida') AS excluido_no_valida
    FROM listings GROUP BY fuente""")
def category_population(x: Listings) -> DataFrame:
    return q.category_population(x.listings)


@query("""
    SELECT l.tipo_propiedad, l.tipo_operacion, count(*) AS n
    FROM listings l JOIN fact f ON f.fuente = l.fuente AND f.id = l.id GROUP BY 1, 2""")
def constant_dimension(x: Listings) -> DataFrame:
    return q.constant_dimensions(x.fact, x.listings, ["tipo_propiedad", "tipo_operacion"])


@query("""
    SELECT f.fuente, round(avg((l.precio_uf - f.precio_uf_oficial)
             / nullif(f.precio_uf_oficial, 0) * 100), 2) AS diff_pct_promedio
    FROM fact f JOIN listings l ON f.fuente = l.fuente AND f.id = l.id
    WHERE l.precio_uf IS NOT NULL GROUP BY f.fuente""")
def layer_reconcile(x: Listings) -> DataFrame:
    return q.indexed_price_gap(x.fact, x.listings)


@query("""
    SELECT (SELECT count(*) FROM listings WHERE fuente = 'alpha') AS stg_alpha,
           (SELECT count(*) FROM listings WHERE fuente = 'beta') AS stg_beta,
           (SELECT count(*) FROM fact) AS fct_arriendos""")
def layer_counts(x: Listings) -> DataFrame:
    return q.layer_counts({"stg_alpha": x.alpha, "stg_beta": x.beta, "fct_arriendos": x.fact})


@query("""
    SELECT fuente, count(*) FILTER (WHERE fecha_publicacion > fecha_scraping) AS n_inconsistentes,
           count(*) AS n_total FROM raw_both GROUP BY fuente""")
def publication_order_check(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.published_after_capture(raw))


# --- profiles -------------------------------------------------------------------------

CATEGORIES = ["tipo_propiedad", "tipo_operacion", "contact_type", "region"]
DAYS = ["fecha_publicacion", "fecha_scraping"]


def _rows_of(x: Listings, name: str) -> DataFrame:
    return x.alpha_rows if name == "alpha" else x.beta_rows


def _numbers_of(name: str) -> list[str]:
    return [*PRICES[name], SOURCES[name].area]


def _per_column(columns: Callable[[str], list[str]], body: str) -> str:
    """``body`` with {c} for each column and {t} for each source's table."""
    return both_sql(
        lambda name: " UNION ALL ".join(
            f"SELECT '{c}' AS columna, {body.format(c=c, t=f'raw_{name}')}" for c in columns(name)
        )
    )


NULLS = _per_column(
    lambda name: SOURCES[name].columns,
    "count(*) FILTER (WHERE {c} IS NULL) AS n_nulos, "
    "round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE, 2) AS pct_nulos FROM {t}",
)
COLLISIONS = _per_column(
    lambda name: [c for c in SOURCES[name].columns if c != "id"],
    "max(n) AS max_distintos FROM (SELECT count(DISTINCT {c}) AS n FROM {t} "
    "WHERE id IN (SELECT id FROM {t} GROUP BY id HAVING count(*) > 1) GROUP BY id)",
)
FREQUENCIES = _per_column(lambda name: CATEGORIES, "{c} AS valor, count(*) AS n FROM {t} GROUP BY {c}")
DUPLICATES = both_sql(
    lambda name: "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicados FROM "
    f"(SELECT count(*) AS n FROM raw_{name} GROUP BY {', '.join(SOURCES[name].columns)})"
)
KEYS = both_sql(
    lambda name: "SELECT count(*) AS total, count(DISTINCT id) AS ids_distintos, "
    f"count(*) - count(DISTINCT id) AS diferencia FROM raw_{name}"
)
STRIPPED = _per_column(
    lambda name: ["comuna"],
    "count(DISTINCT {c}) AS n_unicos, count(DISTINCT {c}) FILTER (WHERE {c} <> trim({c})) AS n_con_espacios, "
    "count(DISTINCT trim({c})) AS n_unicos_sin_espacios FROM {t}",
)
DATES = _per_column(
    lambda name: DAYS,
    "count(*) FILTER (WHERE {c} IS NULL) AS n_sin_parsear, min({c}) AS desde, max({c}) AS hasta FROM {t}",
)
NONPOSITIVE = _per_column(_numbers_of, "count(*) FILTER (WHERE {c} <= 0) AS n_no_positivos FROM {t}")
FIGURES = (
    "count({c}) AS n, round(avg({c}), 4) AS media, round(stddev_samp({c}), 4) AS desviacion, min({c}) AS minimo, "
    "round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
    "round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS maximo FROM {t}"
)


@query(f"""
    SELECT fuente, 'nulos' AS metrica, columna, NULL::VARCHAR AS valor, n_nulos AS n FROM ({NULLS})
    UNION ALL SELECT fuente, 'copias', NULL, NULL, n_duplicados FROM ({DUPLICATES})
    UNION ALL SELECT fuente, 'id_repetido', 'id', NULL, diferencia FROM ({KEYS})
    UNION ALL SELECT fuente, 'max_distintos', columna, NULL, max_distintos FROM ({COLLISIONS})
    UNION ALL SELECT fuente, 'no_positivos', columna, NULL, n_no_positivos FROM ({NONPOSITIVE})
    UNION ALL SELECT fuente, 'sin_parsear', columna, NULL, n_sin_parsear FROM ({DATES})
    UNION ALL SELECT fuente, 'publicacion_posterior', 'fecha_publicacion', NULL,
      count(*) FILTER (WHERE fecha_publicacion > fecha_scraping) FROM raw_both GROUP BY fuente
    UNION ALL SELECT fuente, 'unicos', columna, NULL, n_unicos FROM ({STRIPPED})
    UNION ALL SELECT fuente, 'con_espacios', columna, NULL, n_con_espacios FROM ({STRIPPED})
    UNION ALL SELECT fuente, 'unicos_sin_espacios', columna, NULL, n_unicos_sin_espacios FROM ({STRIPPED})
    UNION ALL SELECT fuente, 'frecuencia', columna, valor, n FROM ({FREQUENCIES})""")
def source_profile(x: Listings) -> DataFrame:
    def profile(raw: DataFrame, _area: str, name: str) -> DataFrame:
        return pf.source_profile(
            raw, _rows_of(x, name), SOURCES[name].columns, _numbers_of(name), CATEGORIES, DAYS, "comuna"
        )

    return both(x, profile)


@query(both_sql(lambda name: f"""
    SELECT id, {PRICES[name][0]} AS precio, {SOURCES[name].area} AS superficie, fecha_scraping FROM raw_{name}
    ORDER BY 1, 2, 3, 4 LIMIT 3"""))
def head_sample(x: Listings) -> DataFrame:
    def first(raw: DataFrame, area: str, name: str) -> DataFrame:
        typed = raw.select(
            "id", pf.number(PRICES[name][0]).alias("precio"), pf.number(area).alias("superficie"),
            pf.day("fecha_scraping").alias("fecha_scraping"),
        )
        return pf.head(typed, typed.columns)

    return both(x, first)


@query(NULLS)
def null_profile(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.null_profile(raw, SOURCES[name].columns))


@query(DUPLICATES)
def exact_duplicates(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.exact_duplicate_count(_rows_of(x, name)))


@query(KEYS)
def duplicate_keys(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.duplicate_key_count(_rows_of(x, name), "id"))


@query(COLLISIONS)
def key_collisions(x: Listings) -> DataFrame:
    return both(
        x,
        lambda raw, area, name: pf.key_collisions(
            _rows_of(x, name), "id", [c for c in SOURCES[name].columns if c != "id"]
        ),
    )


def _delivered_in(day: Column) -> Column:
    months = F.array(F.date_format(day, "yyyy-MM"), F.date_format(F.add_months(day, -1), "yyyy-MM"))
    return F.when(F.dayofmonth(day) <= 3, months).otherwise(F.slice(months, 1, 1))


def redelivered_tree(x: Listings) -> str:
    """Monthly CSV files, in which the first three days of a month are in the month before's file too."""
    if "_redelivered" not in x.__dict__:
        root = x.workspace.path("redelivered")
        for name in SOURCES:
            rows = x.raw_of(name, _delivered_in)
            write_csv_tree(rows, f"{root}/{name}", "periodo", clustered=True, compression="gzip")
        x.__dict__["_redelivered"] = root
    return x.__dict__["_redelivered"]


@query(both_sql(lambda name: f"""
    SELECT CAST(sum(total) AS BIGINT) AS n_filas, count(*) AS n_distintas, CAST(sum(total - archivos) AS BIGINT) AS n_exactos,
           CAST(sum(archivos - 1) AS BIGINT) AS n_entre_archivos, count(*) FILTER (WHERE archivos > 1) AS n_filas_repartidas
    FROM (SELECT count(*) AS total, count(DISTINCT archivo) AS archivos FROM (
      SELECT *, strftime(fecha_scraping, '%Y-%m') AS archivo FROM raw_{name}
      UNION ALL SELECT *, strftime(fecha_scraping - INTERVAL 1 MONTH, '%Y-%m') FROM raw_{name} WHERE day(fecha_scraping) <= 3)
      GROUP BY {', '.join(SOURCES[name].columns)})"""))
def copies_across_files(x: Listings) -> DataFrame:
    """Copies inside a delivered file and between files; a file is known by its period."""

    def copies(_raw: DataFrame, _area: str, name: str) -> DataFrame:
        columns = SOURCES[name].columns
        rows = with_source_file(scan_csv_tree(x.spark, f"{redelivered_tree(x)}/{name}", columns))
        return pf.copies_across_files(rows, columns, "periodo_archivo")

    return both(x, copies)


@query(f"""
    SELECT 'alpha' AS fuente, '{{c}}' AS columna, divisa, {FIGURES} GROUP BY divisa
    UNION ALL """.format(c="precio", t="raw_alpha") + f"""
    SELECT 'alpha', '{{c}}', divisa, {FIGURES} GROUP BY divisa UNION ALL """.format(c="superficie_m2", t="raw_alpha")
    + " UNION ALL ".join(
        f"SELECT 'beta', '{{c}}', NULL, {FIGURES}".format(c=c, t="raw_beta") for c in _numbers_of("beta")))
def numeric_describe(x: Listings) -> DataFrame:
    """All numbers of both sources, the first one's by currency."""

    def figures(raw: DataFrame, _area: str, name: str) -> DataFrame:
        if name == "alpha":
            return pf.describe_numeric(raw, _numbers_of(name), ["divisa"])
        return pf.describe_numeric(raw, _numbers_of(name)).withColumn("divisa", F.lit(None).cast("string"))

    return _rounded(both(x, figures))


@query(_per_column(_numbers_of, FIGURES))
def numeric_describe_overall(x: Listings) -> DataFrame:
    return _rounded(both(x, lambda raw, area, name: pf.describe_numeric(raw, _numbers_of(name))))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, 4) for c in ("media", "desviacion", "q25", "q50", "q75")}
    )


@query(NONPOSITIVE)
def nonpositive_counts(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.nonpositive_counts(raw, _numbers_of(name)))


TAIL = (
    "round(p, 6) AS umbral, max({c}) AS maximo, count(*) FILTER (WHERE {c} > p) AS n_sobre_umbral FROM {t}, "
    "(SELECT quantile_cont({c}, 0.995) AS p FROM {t}) GROUP BY p"
)


@query("""
    SELECT 'alpha' AS fuente, 'precio' AS columna, divisa, round(p, 6) AS umbral, max(precio) AS maximo,
           count(*) FILTER (WHERE precio > p) AS n_sobre_umbral
    FROM raw_alpha JOIN (SELECT divisa, quantile_cont(precio, 0.995) AS p
                         FROM raw_alpha WHERE divisa IS NOT NULL GROUP BY divisa) USING (divisa)
    GROUP BY divisa, p UNION ALL """ + " UNION ALL ".join(
        f"SELECT 'beta', '{c}', NULL, {TAIL.format(c=c, t='raw_beta')}" for c in PRICES["beta"]))
def tail_quantiles(x: Listings) -> DataFrame:
    """Prices: the first source's by currency, the second one's by column."""
    first = pf.tail_report(x.alpha_raw, PRICES["alpha"], 0.995, x.workspace, "divisa")
    second = pf.tail_report(x.beta_raw, PRICES["beta"], 0.995, x.workspace)
    tails = first.withColumn("fuente", F.lit("alpha")).unionByName(
        second.withColumns({"fuente": F.lit("beta"), "divisa": F.lit(None).cast("string")})
    )
    return tails.withColumn("umbral", F.round("umbral", 6))


@query("SELECT count(*) FILTER (WHERE precio_uf IS NULL AND precio_clp IS NOT NULL) "
       "AS n_sin_precio_indexado FROM raw_beta")
def indexed_price_missing(x: Listings) -> DataFrame:
    return pf.indexed_price_missing(x.beta_raw, "precio_uf", "precio_clp")


QUANTILES = {"p95": 0.95, "p99": 0.99}


@query("""
    SELECT fuente, round(quantile_cont(precio_clp_por_m2, 0.95), 6) AS p95,
           round(quantile_cont(precio_clp_por_m2, 0.99), 6) AS p99, max(precio_clp_por_m2) AS maximo,
           count(precio_clp_por_m2) AS n FROM usable GROUP BY fuente""")
def approx_quantiles_rank(x: Listings) -> DataFrame:
    """Exact quantiles where the approximate one's rank, found by counting, is near enough; else NULL."""
    accuracy = 1_000
    usable = usable_listings(x.listings).select("fuente", "precio_clp_por_m2")
    sketch = x.workspace.keep(
        approx_quantiles(usable, ["fuente"], "precio_clp_por_m2", QUANTILES, accuracy), "cuantiles"
    )
    return _where_near(x, usable, sketch, ["fuente"], 1 / accuracy)


def _where_near(x: Listings, usable: DataFrame, sketch: DataFrame, keys: list[str], error: float) -> DataFrame:
    measured = measured_ranks(usable, sketch, keys, "precio_clp_por_m2", QUANTILES)
    exact = x.workspace.keep(exact_quantiles(usable, keys, "precio_clp_por_m2", QUANTILES), "exactos")
    near = {p: F.when(F.col(f"error_{p}") <= error + 1 / F.col("n"), F.round(p, 6)) for p in QUANTILES}
    return measured.join(exact, keys).join(sketch.select(*keys, "maximo"), keys).select(
        *keys, *(c.alias(p) for p, c in near.items()), "maximo", "n"
    )


@query("""
    SELECT fuente, CAST(year(fecha_scraping) AS BIGINT) AS anio, round(quantile_cont(precio_clp_por_m2, 0.95), 6) AS p95,
           round(quantile_cont(precio_clp_por_m2, 0.99), 6) AS p99, max(precio_clp_por_m2) AS maximo,
           count(precio_clp_por_m2) AS n
    FROM usable GROUP BY 1, 2 HAVING count(precio_clp_por_m2) > 0""")
def sketch_quantiles_by_year(x: Listings) -> DataFrame:
    """Yearly quantiles from kept monthly sketches; as above, exact ones show where the rank is near enough."""
    keys = ["fuente", "anio"]
    yearly = merged(x.ratio_sketches, ["fuente", F.year("mes").cast("bigint").alias("anio")])
    found = x.workspace.keep(sketch_quantiles(yearly, keys, QUANTILES), "cuantiles")
    usable = usable_listings(x.listings).select(
        "fuente", F.year("fecha_scraping").cast("bigint").alias("anio"), "precio_clp_por_m2"
    )
    # a sketch is off by more than its published error in one of a hundred cases
    return _where_near(x, usable, found, keys, 2 * rank_error())


@query(FREQUENCIES)
def value_frequencies(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.value_counts_of(raw, CATEGORIES))


@query("SELECT 'divisa' AS columna, divisa AS valor, count(*) AS n FROM raw_alpha "
       "WHERE divisa IS NOT NULL GROUP BY divisa")
def currency_frequencies(x: Listings) -> DataFrame:
    return pf.value_counts(x.alpha_raw, "divisa")


@query(STRIPPED)
def strip_profile(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.strip_profile(raw, "comuna"))


@query(DATES)
def date_profile(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.date_profile(raw, DAYS))


@query("""
    SELECT count(*) AS n_compartidos FROM (
      SELECT substring(id, 4) FROM raw_alpha INTERSECT SELECT substring(id, 4) FROM raw_beta)""")
def source_id_overlap(x: Listings) -> DataFrame:
    """Without their prefixes the ids of the two sources do overlap."""
    bare = F.expr("substring(id, 4)").alias("id")
    return pf.id_overlap(x.alpha_raw.select(bare), x.beta_raw.select(bare))


@query("SELECT fuente, left(id, 3) AS prefijo, count(*) AS n FROM raw_both GROUP BY 1, 2")
def id_prefixes(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: pf.id_prefixes(raw))


# --- anomalies ---------------------------------------------------------------------------

SUSPECTS = ", ".join(f"{v:g}" for v in RULES.suspects)


@query(f"""
    SELECT CAST(v AS DOUBLE) AS valor, count(*) FILTER (WHERE a = v) AS n_exacto,
           count(*) FILTER (WHERE a <> v AND a BETWEEN v - alcance AND v + alcance) AS n_vecinos
    FROM (SELECT l_quantity + l_tax AS a FROM lineitem)
    CROSS JOIN (SELECT v, CASE WHEN v <= 5 THEN 0.5 ELSE 2 END AS alcance
                FROM (SELECT unnest([{SUSPECTS}])::DOUBLE AS v))
    GROUP BY v""")
def spike_test(x: Listings) -> DataFrame:
    areas = x.table("lineitem").select((F.col("l_quantity") + F.col("l_tax")).alias("area"))
    return an.spike_test(areas, "area", RULES.suspects)


@query("""
    SELECT valor, count(a) FILTER (WHERE a = valor) AS n_exacto,
           count(a) FILTER (WHERE a <> valor) AS n_vecinos
    FROM (SELECT DISTINCT p_size + (p_partkey % 12) / 100.0::DOUBLE AS valor, CASE WHEN p_size <= 5 THEN 0.5 ELSE 2 END AS alcance
          FROM part)
    LEFT JOIN (SELECT l_quantity + l_tax AS a FROM lineitem) ON a BETWEEN valor - alcance AND valor + alcance
    GROUP BY valor""")
def spike_test_table(x: Listings) -> DataFrame:
    """Suspects from a table; some of them have no hit."""
    size = F.col("p_size")
    suspects = x.table("part").select(
        (size + (F.col("p_partkey") % 12) / F.lit(100.0)).alias("valor"), F.when(size <= 5, 0.5).otherwise(2.0).alias("alcance")
    )
    areas = x.table("lineitem").select((F.col("l_quantity") + F.col("l_tax")).alias("area"))
    return an.spike_test_of(areas, "area", suspects, x.workspace)


@query(f"""
    SELECT fuente, area AS superficie, count(*) AS n,
           round(100.0 * count(*) / any_value(t.total)::DOUBLE, 3) AS pct_del_total
    FROM raw_both JOIN (SELECT fuente, count(*) AS total FROM raw_both GROUP BY fuente) t
      USING (fuente)
    WHERE area IN ({SUSPECTS}) GROUP BY fuente, area""")
def suspect_impact(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: an.suspect_impact(raw, area, RULES.suspects))


MONTHLY = f"""
    SELECT fuente, mes, n_centinela, n_total_mes,
           round(100.0 * n_centinela / n_total_mes::DOUBLE, 2) AS pct FROM (
      SELECT fuente, strftime(fecha_scraping, '%Y-%m') AS mes, count(*) AS n_total_mes,
             count(*) FILTER (WHERE area IN ({SUSPECTS})) AS n_centinela
      FROM raw_both GROUP BY 1, 2) WHERE n_centinela > 0"""


def _monthly(x: Listings) -> DataFrame:
    return both(x, lambda raw, area, name: an.suspect_monthly(raw, area, RULES.suspects))


@query(MONTHLY)
def suspect_monthly(x: Listings) -> DataFrame:
    return _monthly(x)


@query(f"SELECT fuente, min(pct) AS pct_min, max(pct) AS pct_max FROM ({MONTHLY}) GROUP BY fuente")
def suspect_monthly_range(x: Listings) -> DataFrame:
    return an.share_range(_monthly(x), ["fuente"])


@query("""
    SELECT fuente, count(*) FILTER (WHERE caro) AS n_precio_extremo, count(*) AS n_total,
           round(100.0 * count(*) FILTER (WHERE caro) / count(*)::DOUBLE, 2) AS pct FROM (
      SELECT fuente, CASE WHEN fuente = 'alpha'
               THEN (divisa = 'UF' AND monto > 60) OR (divisa = 'CLP' AND monto > 60000)
               ELSE monto > 60000 OR precio_uf > 60 END AS caro
      FROM raw_both WHERE area IN (25, 40)) GROUP BY fuente""")
def suspect_extreme_price(x: Listings) -> DataFrame:
    def share(raw: DataFrame, area: str, name: str) -> DataFrame:
        if name == "alpha":
            price = pf.number("precio")
            local = F.when(F.col("divisa") == "CLP", price)
            indexed = F.when(F.col("divisa") == "UF", price)
        else:
            local, indexed = pf.number("precio_clp"), pf.number("precio_uf")
        extreme = extreme_price(local, indexed, RULES.extreme_local, RULES.extreme_indexed)
        return an.extreme_price_share(raw, area, [25.0, 40.0], extreme)

    return both(x, share)


@query("""
    SELECT fuente, count(*) FILTER (WHERE area <= 10) AS n_chica,
           round(avg(monto) FILTER (WHERE area <= 10), 4) AS precio_prom_chica,
           round(avg(monto) FILTER (WHERE area > 10), 4) AS precio_prom_resto
    FROM raw_both WHERE monto IS NOT NULL GROUP BY fuente""")
def small_area_price(x: Listings) -> DataFrame:
    price = {"alpha": "precio", "beta": "precio_clp"}
    means = both(x, lambda raw, area, name: an.small_area_prices(raw, area, price[name]))
    return means.withColumns(
        {c: F.round(c, 4) for c in ("precio_prom_chica", "precio_prom_resto")}
    )


@query("""
    SELECT fuente, tipo_propiedad, count(*) AS n FROM raw_both
    WHERE area IN (1, 2, 5) GROUP BY fuente, tipo_propiedad""")
def suspects_by_category(x: Listings) -> DataFrame:
    return both(
        x,
        lambda raw, area, name: an.suspects_by_category(
            raw, area, [1.0, 2.0, 5.0], "tipo_propiedad"
        ),
    )


@query("""
    SELECT fuente, id, precio_clp, superficie_m2,
           round(precio_clp / nullif(superficie_m2, 0), 0) AS precio_clp_por_m2
    FROM listings WHERE comuna = 'Nation 7' AND superficie_m2 BETWEEN 22 AND 24""")
def segment_gap(x: Listings) -> DataFrame:
    return an.segment_gap(x.listings, "Nation 7", 22, 24)


@query("""
    SELECT superficie, count(*) AS n FROM (
      SELECT superficie_m2 AS superficie FROM raw_alpha WHERE divisa = 'UF'
      ORDER BY precio / superficie_m2 DESC, id, fecha_scraping, superficie_m2 LIMIT 40)
    GROUP BY superficie""")
def top_ratio_listings(x: Listings) -> DataFrame:
    indexed = x.alpha_raw.where(F.col("divisa") == "UF")
    top = an.top_by_ratio(indexed, "precio", ALPHA.area, 40, ["id", "fecha_scraping"])
    return an.area_distribution(top)


@query("""
    SELECT id, precio_clp AS precio, superficie_total_m2 AS superficie, fecha_scraping
    FROM raw_beta ORDER BY precio_clp DESC, id, fecha_scraping, superficie_total_m2 LIMIT 5""")
def top_price_listings(x: Listings) -> DataFrame:
    top = an.top_by_price(
        x.beta_raw, "precio_clp", ["id", "precio_clp", BETA.area, "fecha_scraping"], 5,
        ["id", "fecha_scraping", pf.number(BETA.area)],
    )
    return top.select(
        "id", pf.number("precio_clp").alias("precio"), pf.number(BETA.area).alias("superficie"),
        pf.day("fecha_scraping").alias("fecha_scraping"),
    )


# --- metrics -------------------------------------------------------------------------------


@query("""
    SELECT mes, count(*) AS n_avisos, avg(precio_clp) AS precio_promedio,
           round(quantile_cont(precio_clp::DOUBLE, 0.5), 2) AS precio_mediano
    FROM dated GROUP BY mes""")
def price_by_month(x: Listings) -> DataFrame:
    return mt.price_by_month(x.fact)


@query("""
    SELECT g.*, comuna, region,
           rank() OVER (PARTITION BY region ORDER BY variacion_pct DESC NULLS LAST)
             AS puesto_en_region,
           rank() OVER (ORDER BY variacion_pct DESC NULLS LAST) AS puesto
    FROM (SELECT comuna_id, min(anio) AS primer_anio, max(anio) AS ultimo_anio,
                 round(min_by(med, anio), 2) AS mediana_inicial,
                 round(max_by(med, anio), 2) AS mediana_final,
                 round((max_by(med, anio) - min_by(med, anio))
                       / nullif(min_by(med, anio), 0) * 100, 4) AS variacion_pct
          FROM (SELECT comuna_id, extract(year FROM fecha_scraping) AS anio,
                       quantile_cont(precio_clp::DOUBLE, 0.5) AS med
                FROM fact WHERE comuna_id IS NOT NULL GROUP BY 1, 2) GROUP BY comuna_id) g
    JOIN places USING (comuna_id)""")
def place_price_growth(x: Listings) -> DataFrame:
    return mt.place_price_growth(x.fact, x.places)


@query("SELECT mes, round(quantile_cont(m2, 0.5), 4) AS precio_m2_mediano FROM dated GROUP BY mes")
def price_per_m2_by_month(x: Listings) -> DataFrame:
    return mt.price_per_m2_by_month(x.fact)


@query("""
    SELECT mes, fuente, n AS n_avisos, n - antes AS cambio,
           round((n - antes) * 100.0 / nullif(antes, 0)::DOUBLE, 4) AS cambio_pct
    FROM (SELECT mes, fuente, n, lag(n) OVER (PARTITION BY fuente ORDER BY mes) AS antes
          FROM (SELECT mes, fuente, count(DISTINCT id) AS n FROM dated GROUP BY mes, fuente))""")
def supply_by_month(x: Listings) -> DataFrame:
    return mt.supply_by_month(x.fact)


@query("""
    SELECT mes, moneda, round(med, 4) AS mediana,
           round(med / first_value(med) OVER (PARTITION BY moneda ORDER BY mes) * 100, 4) AS indice
    FROM (SELECT mes, 'clp' AS moneda, quantile_cont(precio_clp::DOUBLE, 0.5) AS med
          FROM dated GROUP BY mes
          UNION ALL SELECT mes, 'uf', quantile_cont(precio_uf_oficial, 0.5)
          FROM dated GROUP BY mes)
    WHERE med IS NOT NULL""")
def clp_vs_uf_index(x: Listings) -> DataFrame:
    return mt.currency_index_by_month(x.fact)


@query("""
    SELECT comuna_id, comuna, region, round(a, 4) AS z_oferta, round(b, 4) AS z_dueno,
           round(c, 4) AS z_m2, round(a + b + c, 4) AS atractivo
    FROM (SELECT comuna_id, (n - avg(n) OVER ()) / stddev_samp(n) OVER () AS a,
                 (o / n::DOUBLE - avg(o / n::DOUBLE) OVER ()) / stddev_samp(o / n::DOUBLE) OVER () AS b,
                 (med - avg(med) OVER ()) / stddev_samp(med) OVER () AS c
          FROM place_figures) JOIN places USING (comuna_id)""")
def place_attractiveness(x: Listings) -> DataFrame:
    return mt.place_attractiveness(x.place_figures, x.places)


@query("""
    SELECT comuna_id, comuna, region, n AS n_avisos, o AS n_dueno_directo,
           round(o * 100.0 / n::DOUBLE, 4) AS pct_en_comuna,
           round(o * 100.0 / (sum(o) OVER ())::DOUBLE, 4) AS pct_del_total
    FROM place_figures JOIN places USING (comuna_id)""")
def owner_direct_concentration(x: Listings) -> DataFrame:
    return mt.owner_direct_concentration(x.place_figures, x.places)


@query("""
    SELECT comuna, puesto, fuente, id, precio_clp, superficie_m2, round(relativo, 6) AS relativo
    FROM (SELECT *, row_number() OVER (PARTITION BY comuna_id ORDER BY relativo NULLS LAST, fuente,
                   id, precio_clp, superficie_m2, fecha_publicacion, fecha_scraping) AS puesto
          FROM (SELECT d.*, m2 / nullif(med, 0) AS relativo
                FROM dated d JOIN place_figures USING (comuna_id)
                WHERE contact_type = 'owner_direct'))
    JOIN places USING (comuna_id) WHERE puesto <= 5""")
def top_listings_to_contact(x: Listings) -> DataFrame:
    return mt.top_listings_to_contact(x.fact, x.place_figures, x.places)


@query("""
    SELECT fuente, count(*) AS n_avisos,
           round(quantile_cont(precio_clp::DOUBLE, 0.5), 4) AS precio_mediano,
           round(quantile_cont(m2, 0.5), 4) AS precio_m2_mediano,
           round(quantile_cont(superficie_m2, 0.5), 4) AS superficie_mediana,
           round(count(*) FILTER (WHERE contact_type = 'owner_direct') * 100.0
                 / count(*)::DOUBLE, 4) AS pct_dueno_directo
    FROM dated GROUP BY fuente""")
def source_comparison(x: Listings) -> DataFrame:
    return mt.source_comparison(x.fact)


# --- what the driver calls -------------------------------------------------------------------


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, folder: fn(listings(spark, folder))

    return {name: bind(fn) for name, fn in REGISTRY.queries.items()}


def oracle() -> dict[str, str]:
    return dict(REGISTRY.sql)
