"""The same results in DuckDB SQL on the same tables, as named building blocks."""

from __future__ import annotations

import re

BLOCKS = {
    "placed": """
        SELECT l.*, p.n_name, p.r_name,
               unnest(range(CASE WHEN l.l_partkey % 100 = 0 THEN 2 ELSE 1 END)) AS copia
        FROM lineitem l LEFT JOIN (
          SELECT s_suppkey, n_name, r_name FROM supplier
          JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
        ) p ON p.s_suppkey = l.l_suppkey""",
    "common": """
        SELECT l_linestatus AS estado, l_orderkey || '-' || l_linenumber AS clave,
               CASE WHEN l_suppkey % 25 <> 0
                    THEN ' ' || replace(n_name, '_', '  ') || ' ' END AS lugar,
               r_name AS region, l_extendedprice AS monto, l_tax, l_returnflag,
               l_quantity AS superficie,
               CAST(l_shipdate AS DATE) - CAST(l_linenumber * 7 AS INTEGER) AS fecha_publicacion,
               CAST(l_shipdate AS DATE) AS fecha_scraping,
               CASE WHEN l_partkey % 2 = 0 THEN 'DEPARTAMENTO' ELSE 'departamento' END AS tipo_propiedad,
               CASE WHEN l_partkey % 2 = 0 THEN 'ARRIENDO' ELSE 'arriendo' END AS tipo_operacion,
               CASE WHEN l_suppkey % 3 = 0 THEN 'owner_direct' ELSE 'agency' END AS contacto,
               l_suppkey % 7 = 0 AS sin_contacto
        FROM placed""",
    "raw_alpha": """
        SELECT 'TA-' || clave AS id, 'alpha' AS fuente, lower(lugar) AS comuna, region,
               monto AS precio,
               CASE l_returnflag WHEN 'A' THEN 'UF' WHEN 'N' THEN 'CLP' END AS divisa,
               superficie AS superficie_m2, fecha_publicacion, fecha_scraping,
               tipo_propiedad, tipo_operacion,
               CASE WHEN NOT sin_contacto THEN contacto END AS contact_type
        FROM common WHERE estado = 'F'""",
    "raw_beta": """
        SELECT 'PB-' || clave AS id, 'beta' AS fuente, upper(lugar) AS comuna, region,
               monto AS precio_clp, CASE WHEN l_tax > 0 THEN monto / 1000 END AS precio_uf,
               superficie AS superficie_total_m2, fecha_publicacion, fecha_scraping,
               tipo_propiedad, tipo_operacion, contacto AS contact_type
        FROM common WHERE estado = 'O'""",
    "raw_both": """
        SELECT id, fuente, comuna, region, superficie_m2 AS area, precio AS monto, divisa,
               NULL::DOUBLE AS precio_uf, fecha_publicacion, fecha_scraping,
               tipo_propiedad, tipo_operacion, contact_type FROM raw_alpha
        UNION ALL
        SELECT id, fuente, comuna, region, superficie_total_m2, precio_clp, NULL,
               precio_uf, fecha_publicacion, fecha_scraping,
               tipo_propiedad, tipo_operacion, contact_type FROM raw_beta""",
    "rates": """
        SELECT CAST(o_orderdate AS DATE) AS fecha_dt, max(o_totalprice) / 100 AS valor_uf
        FROM orders GROUP BY 1""",
    "landed": """
        SELECT *, CAST(strftime(fecha_dt, '%Y') AS VARCHAR) AS anio,
               CASE WHEN day(fecha_dt) = 13 AND month(fecha_dt) % 4 = 1 THEN 'fecha_invalida'
                    WHEN day(fecha_dt) = 17 AND month(fecha_dt) % 4 = 2 THEN 'valor_nulo'
                    WHEN day(fecha_dt) = 19 AND month(fecha_dt) % 4 = 3 THEN 'valor_invalido' END AS motivo,
               day(fecha_dt) = 23 AND month(fecha_dt) % 4 = 0 AS dos_veces
        FROM rates""",
    "clean": """
        SELECT DISTINCT * FROM raw_both""",
    "listings": """
        SELECT id, fuente,
               CASE WHEN trim(comuna) <> '' THEN array_to_string(list_transform(
                 list_filter(string_split(lower(trim(comuna)), ' '), lambda w: w <> ''),
                 lambda w: upper(w[1:1]) || w[2:]), ' ') END AS comuna,
               region,
               CASE WHEN upper(trim(tipo_propiedad)) = 'DEPARTAMENTO' THEN 'Departamento'
                    ELSE trim(tipo_propiedad) END AS tipo_propiedad,
               CASE WHEN upper(trim(tipo_operacion)) = 'ARRIENDO' THEN 'Arriendo'
                    ELSE trim(tipo_operacion) END AS tipo_operacion,
               contact_type,
               CASE WHEN area NOT IN (1, 2, 25, 40) THEN area END AS superficie_m2,
               area AS superficie_m2_original,
               CASE WHEN area IN (1, 2, 25, 40) THEN 'centinela'
                    WHEN area IN (5, 8, 10, 12) THEN 'habitacion' ELSE 'valida'
               END AS superficie_categoria,
               fecha_publicacion, fecha_scraping,
               CAST(CASE WHEN fuente = 'beta' OR divisa = 'CLP' THEN round(monto)
                         WHEN divisa = 'UF' THEN round(monto * valor_uf) END AS BIGINT) AS precio_clp,
               CASE WHEN fuente = 'beta' THEN precio_uf WHEN divisa = 'UF' THEN monto
                    WHEN divisa = 'CLP' THEN round(monto / valor_uf, 2) END AS precio_uf,
               CASE WHEN fuente = 'beta' THEN FALSE ELSE divisa = 'UF' END AS precio_clp_es_calculado,
               CASE WHEN fuente = 'beta' THEN FALSE ELSE divisa = 'CLP' END AS precio_uf_es_calculado,
               CASE WHEN fuente = 'alpha' THEN valor_uf END AS valor_uf_referencia
        FROM clean LEFT JOIN rates ON fecha_dt = fecha_scraping""",
    "usable": """
        SELECT *, precio_clp / nullif(superficie_m2, 0) AS precio_clp_por_m2
        FROM listings WHERE superficie_categoria = 'valida'""",
    "limits": """
        SELECT fuente, quantile_cont(precio_clp_por_m2, 0.99) AS umbral FROM usable GROUP BY fuente""",
    "places": """
        SELECT row_number() OVER (ORDER BY comuna) AS comuna_id, comuna, region FROM (
          SELECT comuna, min(region) AS region FROM listings
          WHERE comuna IS NOT NULL GROUP BY comuna)""",
    "fact": """
        SELECT u.id, u.fuente, p.comuna_id, u.contact_type, u.superficie_m2,
               u.fecha_publicacion, u.fecha_scraping, u.precio_clp,
               u.precio_clp / nullif(r.valor_uf, 0) AS precio_uf_oficial
        FROM usable u JOIN limits USING (fuente)
        LEFT JOIN places p ON p.comuna = u.comuna
        LEFT JOIN rates r ON r.fecha_dt = u.fecha_scraping
        WHERE u.precio_clp_por_m2 <= umbral""",
    "dated": """
        SELECT *, strftime(fecha_scraping, '%Y-%m') AS mes,
               precio_clp / nullif(superficie_m2, 0) AS m2 FROM fact""",
    "calendar": """
        SELECT fecha, extract(year FROM fecha) AS anio, extract(month FROM fecha) AS mes,
               extract(day FROM fecha) AS dia, extract(quarter FROM fecha) AS trimestre,
               extract(week FROM fecha) AS semana_anio, extract(isodow FROM fecha) AS dia_semana,
               (['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
                 'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'])[extract(month FROM fecha)]
                 AS nombre_mes,
               (['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'])
                 [extract(isodow FROM fecha)] AS nombre_dia,
               extract(isodow FROM fecha) >= 6 AS es_fin_de_semana
        FROM (SELECT CAST(unnest(generate_series(
                CAST(min(fecha_publicacion) AS TIMESTAMP), CAST(max(fecha_scraping) AS TIMESTAMP),
                INTERVAL 1 DAY)) AS DATE) AS fecha FROM listings)""",
    "place_figures": """
        SELECT comuna_id, count(*) AS n,
               count(*) FILTER (WHERE contact_type = 'owner_direct') AS o,
               quantile_cont(m2, 0.5) AS med
        FROM dated WHERE comuna_id IS NOT NULL GROUP BY comuna_id""",
}


def with_blocks(body: str) -> str:
    """``body`` preceded by the blocks it needs, each after its own needs."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in BLOCKS:
            if name not in order and re.search(rf"\b{name}\b", sql):
                need(BLOCKS[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in order)
    return f"WITH {ctes}\n{body}"
