"""The SQL each registered query is checked with, for DuckDB over the given tables.

Written from the definition of each operator, not from the library's plan: joins come
before aggregates here and windows stand where the library aggregates.
"""

from __future__ import annotations

import re

from checks.bindings import BINDINGS, duckdb_sql
from gondola.functions.text import CATEGORY_RULES, OTHER_CATEGORY
from gondola.operators.clean import STORE_TYPES
from gondola.operators.facts import QUOTE_COLUMNS
from gondola.operators.quality import GRAIN, HEALTH_NOT_NULL, NOT_NULL
from gondola.schema import (
    DATE,
    MERCHANT_KEYS,
    PRODUCT_KEYS,
    QUOTE_KEYS,
    RAW_COLUMNS,
    SILVER,
    STORE_CURRENT_KEYS,
    STORE_KEYS,
)


def _latest(source: str, keys, newest: list[str], columns) -> str:
    rest = [c for c in columns if c not in keys and c not in newest]
    order = ", ".join([f"{c} DESC NULLS LAST" for c in newest] + [f"{c} ASC NULLS LAST" for c in rest])
    return (
        f"SELECT {', '.join(columns)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
    )


def _avg(c: str) -> str:
    # Through text: DuckDB's own casts between doubles and wide decimals are off in the last bits.
    return f"CAST(CAST(SUM(CAST(CAST({c} AS VARCHAR) AS DECIMAL(25,12))) AS VARCHAR) AS DOUBLE) / COUNT({c})"


def _clean_text(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^DISC[: ]+', ''), '^HVDC[: ]+', '')"


def _category(c: str) -> str:
    whens = []
    for category, any_of, all_of, none_of in CATEGORY_RULES:
        terms = ["(" + " OR ".join(f"upper({c}) LIKE '{p}'" for p in any_of) + ")"] if any_of else []
        terms += [f"upper({c}) LIKE '{p}'" for p in all_of] + [f"upper({c}) NOT LIKE '{p}'" for p in none_of]
        whens.append(f"WHEN {' AND '.join(terms)} THEN '{category}'")
    return f"CASE {' '.join(whens)} ELSE '{OTHER_CATEGORY}' END"


def _double(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _int(c: str, kind: str = "INTEGER") -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS {kind})"


def _id(c: str) -> str:
    return f"regexp_replace(trim({c}), '\\.0+$', '')"


def _not_footer(c: str) -> str:
    return f"NOT coalesce(lower({c}) LIKE '%ltima actualizaci%', false)"


def _typed(table: str, **casts: str) -> str:
    return ", ".join(f"{casts[c]} AS {c}" if c in casts else c for c in RAW_COLUMNS[table]) + f", {DATE}"


_SILVER_PRECIOS = list(SILVER["precios"].fieldNames())
_COMPLETE = "NOT (s_acctbal < 0 AND y IN (1995, 1997)) AND NOT (s_acctbal > 8000 AND y = 1996)"
_UNDATED = "(s_nationkey < 5 AND y >= 2000)"
_YEARS = "SELECT *, unnest(range(1995, 2002)) AS y FROM supplier"
_PACKAGE = "'master_' || CAST(s_suppkey AS STRING) || '.zip'"
_CHILD = "'dia/child_' || CAST(y AS STRING) || '.zip'"
_PROMO_COLUMNS = [c for c in RAW_COLUMNS["productos"] if "promo" in c]


def _same(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _semi(rows: str, reference: str, keys) -> str:
    return (
        f"SELECT r.* FROM {rows} r WHERE EXISTS (SELECT 1 FROM {reference} f WHERE {_same('r', 'f', [DATE, *keys])}) "
        f"OR NOT EXISTS (SELECT 1 FROM {reference} f WHERE f.{DATE} = r.{DATE})"
    )


def _anti_keys(rows: str, reference: str, keys) -> str:
    return (
        f"SELECT DISTINCT {', '.join(keys)} FROM {rows} r "
        f"WHERE NOT EXISTS (SELECT 1 FROM {reference} f WHERE {_same('r', 'f', keys)})"
    )


def _to_precios(source: str) -> str:
    return f"""
SELECT id_comercio, CAST(id_bandera AS STRING) AS id_bandera, CAST(id_sucursal AS STRING) AS id_sucursal,
       CAST(id_producto AS STRING) AS id_producto, productos_ean AS ean, productos_descripcion AS descripcion,
       coalesce(productos_marca, 'S/D') AS marca, {_double("productos_cantidad_presentacion")} AS cantidad_presentacion,
       productos_unidad_medida_presentacion AS unidad_medida_presentacion, productos_precio_lista AS precio_lista,
       {_double("productos_precio_referencia")} AS precio_referencia,
       {_double("productos_cantidad_referencia")} AS cantidad_referencia,
       productos_unidad_medida_referencia AS unidad_medida_referencia,
       {_double("productos_precio_unitario_promo1")} AS precio_promo1, productos_leyenda_promo1 AS leyenda_promo1,
       {_double("productos_precio_unitario_promo2")} AS precio_promo2, productos_leyenda_promo2 AS leyenda_promo2,
       {DATE} FROM {source}"""


def _coverage(fact: str) -> str:
    return f"""
SELECT p.{DATE}, s.provincia, COUNT(DISTINCT p.id_sucursal) AS sucursales_activas,
       COUNT(DISTINCT p.id_comercio) AS cadenas_activas, COUNT(DISTINCT p.id_producto) AS productos_reportados,
       COUNT(p.id_producto) AS total_precios
FROM {fact} p LEFT JOIN cur_sucursales s ON p.id_sucursal = s.id_sucursal AND p.id_comercio = s.id_comercio
GROUP BY 1, 2"""


CTES = {name: duckdb_sql(name) for name in BINDINGS} | {
    "cur_comercios": _latest("dim_comercios", MERCHANT_KEYS, [DATE], SILVER["dim_comercios"].fieldNames()),
    "cur_sucursales": _latest("dim_sucursales", STORE_CURRENT_KEYS, [DATE], SILVER["dim_sucursales"].fieldNames()),
    "cur_sucursales3": _latest("dim_sucursales", STORE_KEYS, [DATE], SILVER["dim_sucursales"].fieldNames()),
    "cur_productos": _latest("dim_productos", PRODUCT_KEYS, [DATE], SILVER["dim_productos"].fieldNames()),
    "quotes": _latest("precios", QUOTE_KEYS, ["scraped_at"], QUOTE_COLUMNS),
    "latest": f"""
SELECT l.*, s.nombre, s.localidad, s.provincia, c.bandera_nombre
FROM ({_latest("precios", [*STORE_KEYS, "id_producto"], ["scraped_at"], _SILVER_PRECIOS)}) l
JOIN cur_sucursales3 s ON {_same("l", "s", STORE_KEYS)} JOIN cur_comercios c ON {_same("l", "c", MERCHANT_KEYS)}""",
    "summary": f"""
SELECT p.{DATE}, p.id_producto, MIN(d.descripcion) AS descripcion, MIN(d.marca) AS marca,
       COUNT(*) AS num_observaciones, {_avg("p.precio_lista")} AS precio_promedio,
       MIN(p.precio_lista) AS precio_minimo, MAX(p.precio_lista) AS precio_maximo,
       MIN(p.precio_promo1) AS mejor_precio_promo
FROM precios p LEFT JOIN cur_productos d ON p.id_producto = d.id_producto WHERE p.precio_lista > 0 GROUP BY 1, 2""",
    "coverage": _coverage("precios"),
    "priced": f"""
SELECT q.{DATE}, q.id_producto, q.id_sucursal, q.precio_lista, {_clean_text("q.descripcion")} AS descripcion_clean,
       q.marca, s.provincia
FROM quotes q JOIN cur_sucursales s ON q.id_sucursal = s.id_sucursal AND q.id_comercio = s.id_comercio
WHERE q.precio_lista >= 10 AND s.provincia IS NOT NULL""",
    "series": f"""
SELECT {DATE}, id_producto, MIN(descripcion_clean) AS descripcion_clean, MIN(marca) AS marca,
       {_category("MIN(descripcion_clean)")} AS categoria_inferida, provincia, {_avg("precio_lista")} AS precio_promedio,
       median(precio_lista) AS precio_mediana, MIN(precio_lista) AS precio_min, MAX(precio_lista) AS precio_max,
       round(stddev_samp(precio_lista), 4) AS precio_desvio, COUNT(*) AS num_observaciones,
       COUNT(DISTINCT id_sucursal) AS num_sucursales
FROM priced GROUP BY {DATE}, id_producto, provincia""",
    "chains": f"""
SELECT p.{DATE}, p.id_producto, {_clean_text("d.descripcion")} AS descripcion_clean, d.marca,
       c.bandera_nombre AS cadena, {_avg("p.precio_lista")} AS precio_promedio, COUNT(*) AS num_observaciones
FROM precios p LEFT JOIN cur_productos d ON p.id_producto = d.id_producto
LEFT JOIN cur_comercios c ON {_same("p", "c", MERCHANT_KEYS)}
WHERE p.precio_lista >= 10 AND c.bandera_nombre IS NOT NULL GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) >= 3""",
    "pairs": f"""
SELECT a.{DATE}, a.id_producto, a.descripcion_clean, a.marca, {_category("a.descripcion_clean")} AS categoria_inferida,
       a.cadena AS cadena_a, b.cadena AS cadena_b, a.precio_promedio AS precio_promedio_a,
       b.precio_promedio AS precio_promedio_b, round(ln(a.precio_promedio), 6) AS ln_precio_a,
       round(ln(b.precio_promedio), 6) AS ln_precio_b, a.num_observaciones AS num_obs_a,
       b.num_observaciones AS num_obs_b,
       (b.precio_promedio - a.precio_promedio) / a.precio_promedio * 100 AS diferencia_pct
FROM chains a JOIN chains b ON a.{DATE} = b.{DATE} AND a.id_producto = b.id_producto AND a.cadena < b.cadena""",
    "hypothesis": f"""
SELECT p.{DATE}, p.id_producto, p.id_comercio, p.id_sucursal, {_clean_text("d.descripcion")} AS descripcion_clean,
       d.marca, {_category(_clean_text("d.descripcion"))} AS categoria_inferida, c.bandera_nombre, s.provincia,
       s.localidad, p.precio_lista, p.precio_promo1 IS NOT NULL AS tiene_promo,
       coalesce(p.precio_promo1, p.precio_lista) AS precio_efectivo
FROM precios p LEFT JOIN cur_productos d ON p.id_producto = d.id_producto
LEFT JOIN cur_sucursales s ON p.id_sucursal = s.id_sucursal AND p.id_comercio = s.id_comercio
LEFT JOIN cur_comercios c ON {_same("p", "c", MERCHANT_KEYS)}
WHERE p.precio_lista >= 10 AND s.provincia IS NOT NULL""",
    "ok_comercio": f"""
SELECT * FROM (SELECT {_typed("comercio", id_comercio=_id("id_comercio"), id_bandera=_int("id_bandera"),
       comercio_cuit=_int("comercio_cuit", "BIGINT"), comercio_version_sepa="TRY_CAST(comercio_version_sepa AS FLOAT)")}
       FROM raw_comercio WHERE {_not_footer("id_comercio")})
WHERE id_comercio <> '' AND id_bandera IS NOT NULL""",
    "ok_sucursales": f"""
SELECT * FROM (SELECT {_typed("sucursales", id_comercio=_id("id_comercio"), id_bandera=_int("id_bandera"),
       id_sucursal=_int("id_sucursal"), sucursales_codigo_postal=_int("sucursales_codigo_postal"),
       sucursales_tipo="lower(trim(sucursales_tipo))")}
       FROM raw_sucursales WHERE {_not_footer("id_comercio")})
WHERE id_comercio IS NOT NULL AND id_bandera IS NOT NULL AND id_sucursal IS NOT NULL
  AND sucursales_localidad IS NOT NULL AND sucursales_provincia IS NOT NULL""",
    "read_productos": f"""
SELECT {_typed("productos", id_comercio=_id("id_comercio"), id_bandera=_int("id_bandera"),
       id_sucursal=_int("id_sucursal"), id_producto=_int("id_producto", "BIGINT"),
       productos_ean="CASE WHEN productos_ean IN ('1', 'True', 'true') THEN true "
       "WHEN productos_ean IN ('0', 'False', 'false', '') THEN false END",
       productos_precio_lista=_double("productos_precio_lista"))}
FROM raw_productos WHERE {_not_footer("id_producto")}""",
    "keyed_productos": """
SELECT * FROM read_productos WHERE id_comercio IS NOT NULL AND id_bandera IS NOT NULL AND id_sucursal IS NOT NULL
  AND id_producto IS NOT NULL AND productos_precio_lista IS NOT NULL AND productos_descripcion IS NOT NULL""",
    "positive_productos": "SELECT * FROM keyed_productos WHERE NOT productos_precio_lista <= 0",
    "ok_productos": "SELECT * FROM positive_productos WHERE productos_precio_lista <= 1e12",
    "joined_sucursales": _semi("ok_sucursales", "ok_comercio", MERCHANT_KEYS),
    "joined_productos": _semi("ok_productos", "joined_sucursales", STORE_KEYS),
    "drops": f"""
SELECT {DATE}, CAST(SUM(k) AS BIGINT) AS validation_dropped, CAST(SUM(o) AS BIGINT) AS integrity_dropped,
       CAST(SUM(n) AS BIGINT) AS negative_price_count, CAST(SUM(a) AS BIGINT) AS absurd_price_count,
       CAST(SUM(l) AS BIGINT) AS silver_loaded
FROM (SELECT {DATE}, 1 AS k, 0 AS o, 0 AS n, 0 AS a, 0 AS l FROM read_productos
      UNION ALL SELECT {DATE}, -1, 0, 1, 0, 0 FROM keyed_productos
      UNION ALL SELECT {DATE}, 0, 0, -1, 1, 0 FROM positive_productos
      UNION ALL SELECT {DATE}, 0, 1, 0, -1, 0 FROM ok_productos
      UNION ALL SELECT {DATE}, 0, -1, 0, 0, 1 FROM joined_productos) GROUP BY 1""",
    "silver_audit": f"""
SELECT {DATE}, 'silver_precios' AS table_type, validation_dropped + absurd_price_count AS validation_dropped,
       integrity_dropped, negative_price_count,
       silver_loaded, TIMESTAMP '2002-01-01 12:00:00' AS ingested_at FROM drops""",
    "children": f"""
SELECT {_PACKAGE} AS package, {_CHILD} AS child, s_suppkey, y, {_COMPLETE} AS ok,
       NOT (s_acctbal < 0 AND y = 1995) AND NOT {_UNDATED} AS dated, {_UNDATED} AS undated FROM ({_YEARS})""",
    "child_products": f"SELECT *, CAST(id_sucursal AS BIGINT) AS s, year({DATE}) AS d FROM raw_productos "
    "WHERE id_sucursal IS NOT NULL",
}

# Names of the models as the quality rules know them.
CTES |= {
    "stg_precios": "SELECT * FROM precios",
    "stg_dim_comercios": "SELECT * FROM dim_comercios",
    "stg_dim_productos": "SELECT * FROM dim_productos",
    "stg_dim_sucursales": "SELECT * FROM dim_sucursales",
    "fct_price_quotes": "SELECT * FROM quotes",
    "dim_productos_current": "SELECT * FROM cur_productos",
    "dim_sucursales_current": "SELECT * FROM cur_sucursales",
    "dim_comercios_current": "SELECT * FROM cur_comercios",
    "mart_daily_price_summary": "SELECT * FROM summary",
    "mart_store_coverage": "SELECT * FROM coverage",
    "gold_price_timeseries": "SELECT * FROM series",
    "gold_cross_price_elasticity": "SELECT * FROM pairs",
    "gold_price_hypothesis": "SELECT * FROM hypothesis",
}


def _needed(sql: str, seen: list[str]) -> None:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    for name, body in CTES.items():
        if name in words and name not in seen:
            _needed(body.replace(f"AS {name}", ""), seen)
            seen.append(name)


def _with(sql: str) -> str:
    """The query with the CTEs it names, dependencies first."""
    seen: list[str] = []
    _needed(sql, seen)
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in seen)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _health() -> str:
    parts = []
    for table, columns in HEALTH_NOT_NULL.items():
        checks = [("filas", "error", "COUNT(*)", "COUNT(*) > 0")]
        for c in columns:
            n = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
            checks.append((f"nulos_{c}", "error", n, f"{n} = 0"))
        if table == "precios":
            n = "COUNT(*) FILTER (WHERE precio_lista < 10)"
            checks.append(("bajo_minimo", "warn", n, f"{n} = 0"))
        if table == "dim_productos":
            n = "COUNT(*) - COUNT(DISTINCT id_producto)"
            checks.append(("duplicados", "warn", n, f"{n} = 0"))
        if table == "dim_sucursales":
            n = "COUNT(*) FILTER (WHERE NOT regexp_matches(provincia, '^AR-[A-Z]$'))"
            checks.append(("provincia_invalida", "error", n, f"{n} = 0"))
        parts += [
            f"SELECT {DATE}, '{table}' AS tabla, '{name}' AS control, '{severity}' AS severidad, "
            f"{value} AS valor, {passed} AS aprobado FROM {table} GROUP BY 1"
            for name, severity, value, passed in checks
        ]
    return _union(parts)


def _null_text(columns) -> str:
    return ", ".join(f"CASE WHEN {c} NOT IN ('', 'NULL', 'null') THEN {c} END AS {c}" for c in columns)


_STORE_TYPES = ", ".join(f"'{t}'" for t in STORE_TYPES)
_OTHER_PAGE_PROMO = "coalesce(productos_ean, '') NOT IN ('0', '1')"

BODIES = {
    "dim_comercios_current": "SELECT * FROM cur_comercios",
    "dim_sucursales_current": "SELECT * FROM cur_sucursales",
    "dim_productos_current": "SELECT * FROM cur_productos",
    "stg_precios": "SELECT * FROM precios",
    "fct_price_quotes": "SELECT * FROM quotes",
    "latest_prices": "SELECT * FROM latest",
    "price_comparison": f"""
SELECT p.id_producto, d.descripcion, d.marca, p.id_comercio, c.bandera_nombre, p.id_sucursal, s.nombre, s.localidad,
       p.precio_lista, p.{DATE},
       CAST(CAST(SUM(CAST(CAST(p.precio_lista AS VARCHAR) AS DECIMAL(25,12))) OVER w AS VARCHAR) AS DOUBLE) / COUNT(*) OVER w AS precio_promedio,
       MIN(p.precio_lista) OVER w AS precio_minimo, MAX(p.precio_lista) OVER w AS precio_maximo
FROM precios p JOIN cur_productos d ON p.id_producto = d.id_producto
JOIN cur_sucursales3 s ON {_same("p", "s", STORE_KEYS)} JOIN cur_comercios c ON {_same("p", "c", MERCHANT_KEYS)}
WHERE p.scraped_at >= DATE '2001-11-05' - INTERVAL 1500 DAY
WINDOW w AS (PARTITION BY p.id_producto, p.{DATE})""",
    "mart_daily_price_summary": "SELECT * FROM summary",
    "mart_store_coverage": "SELECT * FROM coverage",
    "gold_price_timeseries": "SELECT * FROM series",
    # Up to its accuracy in rows an approximate percentile is the discrete one.
    "approx_median": f"""
SELECT {DATE}, id_producto, provincia, quantile_disc(precio_lista, 0.5) AS precio_mediana,
       MIN(precio_lista) AS precio_min, MAX(precio_lista) AS precio_max FROM priced GROUP BY 1, 2, 3""",
    "chain_avg_prices": "SELECT * FROM chains",
    "gold_cross_price_elasticity": "SELECT * FROM pairs",
    "gold_price_hypothesis": "SELECT * FROM hypothesis",
    "clean_description": f"SELECT {DATE}, descripcion, {_clean_text('descripcion')} AS descripcion_clean "
    "FROM dim_productos",
    "categorize_product": f"SELECT {DATE}, limpia, {_category('limpia')} AS categoria "
    f"FROM (SELECT {DATE}, {_clean_text('descripcion')} AS limpia FROM dim_productos)",
    "soft_cast": f"""
SELECT {DATE}, id_producto, productos_precio_lista, {_int("id_bandera")} AS bandera,
       {_int("id_producto", "BIGINT")} AS producto, {_double("productos_precio_lista")} AS precio,
       {_int("productos_precio_lista")} AS precio_entero FROM raw_productos""",
    "business_date": """
SELECT o_orderkey, CAST(o_orderdate - INTERVAL 3 HOUR AS DATE) AS dia,
       list_extract(['lunes', 'martes', 'miercoles', 'jueves', 'viernes', 'sabado', 'domingo'],
                    CAST(isodow(CAST(o_orderdate - INTERVAL 3 HOUR AS DATE)) AS INT)) AS nombre FROM orders""",
    "date_window_scan": f"SELECT {DATE}, id_producto, COUNT(*) AS filas, MAX(precio_lista) AS maximo FROM precios "
    f"WHERE {DATE} >= DATE '1999-12-29' GROUP BY 1, 2",
    "footer_filter": f"SELECT {DATE}, COUNT(*) AS filas, COUNT(id_producto) AS con_producto FROM raw_productos "
    f"WHERE {_not_footer('id_producto')} GROUP BY 1",
    "clean_comercio": "SELECT * FROM ok_comercio",
    "clean_sucursales": "SELECT * FROM ok_sucursales",
    "clean_productos": "SELECT * FROM ok_productos",
    "store_type_unknown": f"""
SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) AS filas, COUNT(*) AS tipos,
       array_to_string(list_slice(list_sort(list(tipo)), 1, 10), ', ') AS muestras
FROM (SELECT sucursales_tipo AS tipo, COUNT(*) AS n FROM ok_sucursales
      WHERE sucursales_tipo NOT IN ({_STORE_TYPES}) GROUP BY 1)""",
    "merged_dimensions": "SELECT DISTINCT * FROM ok_comercio",
    "to_silver_precios": _to_precios("ok_productos"),
    "to_silver_productos": f"""
SELECT id_producto, ean, descripcion, marca, cantidad_presentacion, unidad_medida_presentacion, {DATE}
FROM ({_to_precios("ok_productos")})""",
    "distinct_products": _latest(
        f"({_to_precios('ok_productos')})", [DATE, "id_producto"], [], SILVER["dim_productos"].fieldNames()
    ),
    "to_silver_sucursales": f"""
SELECT id_comercio, CAST(id_bandera AS STRING) AS id_bandera, CAST(id_sucursal AS STRING) AS id_sucursal,
       sucursales_nombre AS nombre, sucursales_tipo AS tipo, sucursales_calle AS calle, sucursales_numero AS numero,
       {_double("sucursales_latitud")} AS latitud, {_double("sucursales_longitud")} AS longitud,
       CAST(sucursales_codigo_postal AS STRING) AS codigo_postal, sucursales_localidad AS localidad,
       regexp_replace(sucursales_provincia, '^Buenos Aires$', 'AR-B') AS provincia, sucursales_barrio AS barrio, {DATE}
FROM ok_sucursales""",
    "to_silver_comercios": f"""
SELECT id_comercio, CAST(id_bandera AS STRING) AS id_bandera, CAST(comercio_cuit AS STRING) AS cuit,
       comercio_razon_social AS razon_social, comercio_bandera_nombre AS bandera_nombre,
       comercio_bandera_url AS bandera_url, {DATE} FROM ok_comercio""",
    "orphan_stores": _anti_keys("ok_sucursales", "ok_comercio", [DATE, *MERCHANT_KEYS]),
    "semi_stores": "SELECT * FROM joined_sucursales",
    "orphan_prices": _anti_keys("ok_productos", "joined_sucursales", [DATE, *STORE_KEYS]),
    "semi_prices": "SELECT * FROM joined_productos",
    "drop_stats": "SELECT * FROM drops",
    "table_counts": _union(
        [
            f"SELECT '{label}' AS tabla, COUNT(*) AS filas FROM {source}"
            for label, source in (
                ("Comercios", "cur_comercios"),
                ("Sucursales", "cur_sucursales"),
                ("Productos Master", "cur_productos"),
                ("Precios (Fact)", "precios"),
            )
        ]
    ),
    "prices_by_banner": f"SELECT c.bandera_nombre, COUNT(*) AS precios FROM precios p "
    f"JOIN cur_comercios c ON {_same('p', 'c', MERCHANT_KEYS)} GROUP BY 1",
    "price_outliers": f"""
SELECT d.descripcion, d.marca, p.precio_lista, c.bandera_nombre FROM precios p
JOIN cur_productos d ON p.id_producto = d.id_producto JOIN cur_comercios c ON {_same("p", "c", MERCHANT_KEYS)}
WHERE p.precio_lista > 1000000 OR p.precio_lista < 1
ORDER BY p.precio_lista DESC, d.descripcion NULLS LAST, d.marca NULLS LAST, c.bandera_nombre NULLS LAST LIMIT 50""",
    "product_chain_coverage": f"""
SELECT d.descripcion, COUNT(DISTINCT c.bandera_nombre) AS cadenas FROM precios p
JOIN cur_productos d ON p.id_producto = d.id_producto JOIN cur_comercios c ON {_same("p", "c", MERCHANT_KEYS)}
GROUP BY 1 ORDER BY cadenas DESC, d.descripcion NULLS LAST LIMIT 20""",
    "latest_scrape": "SELECT MAX(scraped_at) AS latest_scrape_date FROM precios",
    "basket_cost": """
SELECT basket_id, id_comercio, id_bandera, id_sucursal, productos, total,
       CASE WHEN COUNT(*) OVER w > 1 THEN
         CAST(CAST(MAX(units) OVER w - units AS VARCHAR) AS DOUBLE) END AS ahorro
FROM (SELECT b.basket_id, l.id_comercio, l.id_bandera, l.id_sucursal, COUNT(*) AS productos,
             SUM(CAST(CAST(l.precio_lista AS VARCHAR) AS DECIMAL(25,12)) * b.cantidad) AS units,
             CAST(CAST(SUM(CAST(CAST(l.precio_lista AS VARCHAR) AS DECIMAL(25,12)) * b.cantidad) AS VARCHAR) AS DOUBLE) AS total, b.items
      FROM latest l JOIN (SELECT p_type AS basket_id, p_brand AS id_producto, MAX(p_size) AS cantidad,
                                 COUNT(*) OVER (PARTITION BY p_type) AS items
                          FROM part GROUP BY p_type, p_brand) b ON l.id_producto = b.id_producto
      GROUP BY b.basket_id, l.id_comercio, l.id_bandera, l.id_sucursal, b.items HAVING COUNT(*) = b.items)
WINDOW w AS (PARTITION BY basket_id)""",
    "audit_silver": "SELECT * FROM silver_audit",
    "audit_latest": f"SELECT * FROM silver_audit ORDER BY ingested_at DESC, {DATE} DESC LIMIT 3",
    "dq_null_audit": _union(
        [
            f"SELECT {DATE}, COUNT(*) AS filas, '{c}' AS columna, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos, "
            f"100.0E0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) AS pct_nulos FROM precios GROUP BY 1"
            for c in HEALTH_NOT_NULL["precios"]
        ]
    ),
    "dq_duplicate_products": f"""
SELECT {DATE}, COUNT(*) AS filas, COUNT(DISTINCT id_producto) AS unicos,
       COUNT(*) - COUNT(DISTINCT id_producto) AS duplicados FROM dim_productos GROUP BY 1""",
    "dq_province": f"""
SELECT {DATE}, COUNT(DISTINCT p) AS provincias, COUNT(*) FILTER (WHERE p IS NULL) AS nulos,
       COUNT(DISTINCT p) FILTER (WHERE NOT regexp_matches(p, '^AR-[A-Z]$')) AS valores_invalidos,
       COUNT(*) FILTER (WHERE NOT regexp_matches(p, '^AR-[A-Z]$')) AS filas_invalidas
FROM (SELECT {DATE}, sucursales_provincia AS p FROM raw_sucursales) GROUP BY 1""",
    "dq_low_price": f"SELECT {DATE}, COUNT(*) FILTER (WHERE precio_lista < 10) AS bajo_minimo FROM precios GROUP BY 1",
    "dq_not_null": _union(
        [
            f"SELECT '{t}' AS tabla, '{c}' AS columna, COUNT(*) FILTER (WHERE {c} IS NULL) AS fallas FROM {t}"
            for t, columns in NOT_NULL.items()
            for c in columns
        ]
    ),
    "dq_unique": "SELECT id_producto, COUNT(*) AS n FROM dim_productos GROUP BY 1 HAVING COUNT(*) > 1",
    "dq_grain": _union(
        [
            f"SELECT '{t}' AS tabla, COUNT(*) AS claves, CAST(coalesce(SUM(n), 0) AS BIGINT) AS filas FROM "
            f"(SELECT COUNT(*) AS n FROM {t} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1)"
            for t, keys in (GRAIN | {"stg_precios": GRAIN["fct_price_quotes"]}).items()
        ]
    ),
    "silver_health": _health(),
    "raw_csv_clean": f"SELECT {_null_text(RAW_COLUMNS['productos'])} FROM raw_productos",
    "align_by_name": f"""
SELECT * EXCLUDE (otra) REPLACE ({", ".join(f"CASE WHEN NOT otra THEN {c} END AS {c}" for c in _PROMO_COLUMNS)},
  CASE WHEN NOT otra OR coalesce(id_comercio, '') NOT LIKE '%3' THEN id_bandera END AS id_bandera)
FROM (SELECT {_null_text(RAW_COLUMNS["productos"])}, {_OTHER_PAGE_PROMO} AS otra FROM raw_productos)""",
    "merged_schema_scan": f"""
SELECT id_producto, precio_lista, CASE WHEN {DATE} >= DATE '1998-01-01' THEN precio_promo1 END AS precio_promo1, {DATE}
FROM precios""",
    "silver_day_replace": f"""
SELECT * REPLACE (TIMESTAMP '2002-01-01 12:00:00' AS scraped_at,
  CASE WHEN {DATE} = DATE '1999-01-01' THEN precio_lista + 1 ELSE precio_lista END AS precio_lista) FROM precios""",
    "dim_snapshot_replace": f"""
SELECT * REPLACE (CASE WHEN {DATE} = DATE '1999-01-01' THEN upper(nombre) ELSE nombre END AS nombre)
FROM dim_sucursales""",
    "dim_current_maintained": _latest(
        f"(SELECT * REPLACE (CASE WHEN {DATE} = DATE '2000-01-01' THEN upper(nombre) ELSE nombre END AS nombre) "
        f"FROM dim_sucursales WHERE {DATE} < DATE '2001-01-01')",
        STORE_CURRENT_KEYS,
        [DATE],
        SILVER["dim_sucursales"].fieldNames(),
    ),
    "bronze_partition_scan": f"""
SELECT strftime({DATE}, '%Y') AS year, '01' AS month, '01' AS day, COUNT(*) AS filas,
       COUNT(productos_precio_lista) AS con_precio
FROM raw_productos WHERE {DATE} BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' GROUP BY 1""",
    "bronze_commit": _union(
        [
            f"SELECT '{t}' AS tabla, COUNT(*) AS filas FROM raw_{t} WHERE {DATE} = DATE '2001-01-01'"
            for t in RAW_COLUMNS
        ]
    ),
    "bronze_range_commit": _union(
        [
            f"SELECT '{t}' AS tabla, {DATE}, COUNT(*) AS filas, "
            + (f"SUM(CASE WHEN {DATE} = DATE '2001-01-01' THEN 1 ELSE 0 END)" if t == "productos" else "0")
            + f"::BIGINT AS otras FROM raw_{t} WHERE {DATE} IN (DATE '2000-01-01', DATE '2001-01-01') GROUP BY {DATE}"
            for t in RAW_COLUMNS
        ]
    ),
    "retention_plan": f"SELECT {DATE}, COUNT(*) AS filas, {DATE} < CAST(DATE '2001-11-05' - INTERVAL 1500 DAY AS DATE) "
    "AS borrar FROM precios GROUP BY 1",
    "incremental_window": f"""
SELECT {DATE}, COUNT(*) AS filas FROM precios
WHERE {DATE} >= (SELECT MAX({DATE}) - INTERVAL 2 DAY FROM precios WHERE scraped_at < DATE '2000-01-01') GROUP BY 1""",
    "incremental_upsert": f"""
SELECT * FROM ({_coverage("(SELECT * FROM precios WHERE scraped_at < DATE '1999-07-01')")}) o
WHERE NOT EXISTS (SELECT 1 FROM coverage c WHERE c.{DATE} >= DATE '1998-12-30' AND c.{DATE} = o.{DATE}
                  AND c.provincia IS NOT DISTINCT FROM o.provincia)
UNION ALL SELECT * FROM coverage WHERE {DATE} >= DATE '1998-12-30'""",
    "backfill_range": f"""
SELECT d.* EXCLUDE (absurd_price_count) REPLACE (validation_dropped + absurd_price_count AS validation_dropped), f.filas, f.productos, f.productos AS dim_productos FROM drops d
JOIN (SELECT {DATE}, COUNT(*) AS filas, COUNT(DISTINCT id_producto) AS productos FROM joined_productos GROUP BY 1) f
  ON d.{DATE} = f.{DATE} WHERE d.{DATE} BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    "stream_ingest": f"""
SELECT {DATE}, COUNT(*) AS filas, COUNT(DISTINCT id_producto) AS productos FROM joined_productos GROUP BY 1""",
    "archive_members": f"""
SELECT package, child, 'comercio' AS "table", CASE WHEN undated THEN 1 ELSE 2 END::BIGINT AS lineas FROM children WHERE ok
UNION ALL SELECT package, child, 'sucursales', 1::BIGINT FROM children WHERE ok
UNION ALL SELECT package, child, 'productos', COUNT(*) FROM children JOIN child_products ON s = s_suppkey AND d = y
WHERE ok GROUP BY 1, 2""",
    "package_completeness": """
SELECT package, COUNT(*) AS children, COUNT(*) FILTER (WHERE ok) AS parsed, COUNT(*) FILTER (WHERE NOT ok) AS malformed,
       COUNT(*) FILTER (WHERE ok AND dated AND y <= 1997) AS stale, COUNT(*) FILTER (WHERE NOT ok OR undated) AS unknown
FROM children GROUP BY 1""",
    "package_freshness": """
SELECT package, COUNT(*) FILTER (WHERE dated AND y >= 1998) AS valid, COUNT(*) FILTER (WHERE dated AND y <= 1997) AS stale,
       COUNT(*) FILTER (WHERE NOT dated) AS unknown,
       COUNT(*) FILTER (WHERE dated AND y <= 1997) <= COUNT(*) FILTER (WHERE dated AND y >= 1998) AS accepted
FROM children GROUP BY 1""",
    "bronze_build": f"""
SELECT package, child, {_null_text(RAW_COLUMNS["productos"])} FROM children
JOIN child_products ON s = s_suppkey AND d = y WHERE ok""",
    "bronze_build_all": f"""
SELECT 'comercio' AS tabla, make_date(y::INT, 1, 1) AS {DATE}, SUM(CASE WHEN undated THEN 1 ELSE 2 END)::BIGINT AS filas,
       COUNT(*) AS banderas FROM children WHERE ok GROUP BY y
UNION ALL SELECT 'sucursales', make_date(y::INT, 1, 1), COUNT(*), COUNT(*) FROM children WHERE ok GROUP BY y
UNION ALL SELECT 'productos', make_date(y::INT, 1, 1), COUNT(*), COUNT(id_bandera) FROM children
JOIN child_products ON s = s_suppkey AND d = y WHERE ok GROUP BY y""",
    "audit_bronze": f"""
SELECT v.{DATE}, 'bronze_' || t AS table_type, n AS csv_row_count, CAST(w AS INTEGER) AS csv_column_count,
       n AS parquet_row_count, 'masters' AS raw_zip_path, 'bronze/' || t AS parquet_path, malformed AS malformed_zips_count,
       stale AS stale_count, unknown AS unknown_count, TIMESTAMP '2002-01-01 12:00:00' AS ingested_at
FROM ({_union([f"SELECT {DATE}, '{t}' AS t, {len(c)} AS w, COUNT(*) AS n FROM raw_{t} GROUP BY 1" for t, c in RAW_COLUMNS.items()])}) v
JOIN (SELECT y, COUNT(*) FILTER (WHERE NOT ok) AS malformed, COUNT(*) FILTER (WHERE ok AND dated AND y <= 1997) AS stale,
             COUNT(*) FILTER (WHERE NOT ok OR undated) AS unknown FROM children GROUP BY 1) c ON year(v.{DATE}) = c.y""",
    "page_links": """
SELECT page_id, CAST(len(l) AS BIGINT) AS enlaces, f.archivos
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)
LEFT JOIN (SELECT page_id, COUNT(*) AS archivos
           FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS h FROM pages)
           WHERE lower(h) LIKE '%download%' OR lower(h) LIKE '%.zip%' GROUP BY 1) f USING (page_id)""",
    "package_links": f"""
SELECT s_suppkey AS page_id, CAST(y - 1995 AS INTEGER) AS posicion, CAST(y AS STRING) || '-01-01' AS fecha,
       CASE WHEN y < 1998 THEN '/files/s' || CAST(s_suppkey AS STRING) || '_' || CAST(y AS STRING) || '.zip'
            ELSE '/go/' || CAST(s_suppkey AS STRING) || '/' || CAST(y AS STRING) END AS href
FROM ({_YEARS}) WHERE y < 2000""",
    "guarded_query": f"""
SELECT p.{DATE}, c.razon_social, COUNT(*) AS filas, MAX(p.precio_lista) AS maximo FROM precios p
JOIN dim_comercios c ON {_same("p", "c", [*MERCHANT_KEYS, DATE])} GROUP BY 1, 2""",
    "preview_table": f"SELECT c.bandera_nombre, COUNT(*) AS precios FROM precios p "
    f"JOIN cur_comercios c ON {_same('p', 'c', MERCHANT_KEYS)} GROUP BY 1",
}

ORACLES = {name: _with(body) for name, body in BODIES.items()}
