"""The given tables dressed as raw and silver price data.

Region, nation and supplier play merchant, banner and store; part is the product and
lineitem the price rows. Each binding is one SELECT that Spark and DuckDB both run, so a
query and its check start from the same rows; ``{name}`` stands for a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "supplier", "part", "lineitem", "pages", "orders", "customer")

# Descriptions picked per part; several fall under an earlier category rule than one expects.
_DESCRIPTIONS = (
    "LECHE ENTERA 1L",
    "YOGUR BEBIBLE",
    "ACEITE GIRASOL",
    "YERBA MATE 500G",
    "CAFE MOLIDO",
    "CHOCOLATE BLANCO",
    "DETERGENTE X 750",
    "PASTA DENTAL",
    "TOMATE PELADO",
    "SOBRE DE CAFE",
    "Ñoquis de papa",
    "Azúcar común",
    "COCA LIGHT COLA",
    "7 LIMA UP",
    "AGUA SIN GAS",
    "JABON EN POLVO ROPA",
    "Jabón de Tocador",
    "ATÚN AL NATURAL",
    "PALITO SALADO",
    "DESODORANTE DE AMBIENTE",
)
_DESCRIPTION = (
    "CASE WHEN p_size < 5 THEN 'DISC: ' WHEN p_size < 8 THEN 'HVDC ' WHEN p_size = 8 THEN 'DISC: HVDC ' "
    "ELSE '' END || CASE p_partkey % 20 "
    + " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(_DESCRIPTIONS))
    + " END || ' ' || p_name"
)
_BRAND = "CASE WHEN p_size = 13 THEN NULL ELSE p_brand END"
_PROVINCE = "CASE WHEN s_acctbal < 0 THEN NULL ELSE 'AR-' || chr(CAST(65 + s_suppkey % 24 AS INT)) END"
_PROMO = "CASE WHEN l_discount >= 0.05 THEN l_extendedprice * (1 - l_discount) END"
_DAY = "make_date(CAST(year(l_shipdate) AS INT), 1, 1)"
_SALE = """{lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
         JOIN {nation} ON s_nationkey = n_nationkey"""

# One snapshot per ship year; some keys of each dimension match no price row.
_SNAPSHOTS = "{supplier_years} JOIN {nation} ON s_nationkey = n_nationkey"

SILVER_BINDINGS = {
    "precios": f"""
SELECT CAST(n_regionkey AS STRING) AS id_comercio, CAST(s_nationkey AS STRING) AS id_bandera,
       CAST(l_suppkey AS STRING) AS id_sucursal, p_brand AS id_producto,
       l_returnflag = 'A' AS ean, {_DESCRIPTION} AS descripcion, {_BRAND} AS marca,
       l_quantity AS cantidad_presentacion, 'un' AS unidad_medida_presentacion,
       CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN 0.5E0
            WHEN l_linenumber = 7 AND l_quantity = 49 THEN 0E0
            WHEN l_linenumber = 7 AND l_quantity = 48 THEN l_extendedprice * 1000
            WHEN l_linenumber = 7 AND l_quantity = 44 THEN 10.000043E0
            ELSE l_extendedprice END AS precio_lista,
       p_retailprice AS precio_referencia, 1E0 AS cantidad_referencia, 'un' AS unidad_medida_referencia,
       {_PROMO} AS precio_promo1,
       CASE WHEN l_discount >= 0.05 THEN 'Promo ' || l_returnflag END AS leyenda_promo1,
       CAST(NULL AS DOUBLE) AS precio_promo2, CAST(NULL AS STRING) AS leyenda_promo2,
       {_DAY} AS fecha_vigencia, l_shipdate AS scraped_at
FROM {_SALE}""",
    "dim_sucursales": f"""
SELECT CAST(n_regionkey AS STRING) AS id_comercio, CAST(s_nationkey AS STRING) AS id_bandera,
       CASE WHEN s_acctbal > 9000 OR (s_acctbal > 5000 AND y > 1998) THEN 'otra-' ELSE '' END
         || CAST(s_suppkey AS STRING) AS id_sucursal, s_name || ' ' || CAST(y AS STRING) AS nombre,
       CASE WHEN s_nationkey < 12 THEN 'supermercado' ELSE 'web' END AS tipo,
       CAST(NULL AS STRING) AS calle, CAST(NULL AS STRING) AS numero,
       s_acctbal AS latitud, CAST(NULL AS DOUBLE) AS longitud, CAST(NULL AS STRING) AS codigo_postal,
       n_name AS localidad, {_PROVINCE} AS provincia, CAST(NULL AS STRING) AS barrio,
       make_date(CAST(y AS INT), 1, 1) AS fecha_vigencia
FROM {_SNAPSHOTS}""",
    "dim_comercios": """
SELECT CAST(n_regionkey AS STRING) AS id_comercio,
       CASE WHEN n_name = 'NATION_7' THEN 'otra-' ELSE '' END || CAST(n_nationkey AS STRING) AS id_bandera,
       '30' || CAST(n_nationkey AS STRING) AS cuit, r_name AS razon_social,
       CASE WHEN n_name <> 'NATION_3' THEN 'CADENA ' || chr(CAST(65 + floor(n_nationkey / 2.0) AS INT)) END
         AS bandera_nombre,
       'https://' || lower(n_name) || '.example' AS bandera_url,
       make_date(CAST(y AS INT), 1, 1) AS fecha_vigencia
FROM {nation_years} JOIN {region} ON n_regionkey = r_regionkey""",
    "dim_productos": f"""
SELECT CASE WHEN p_brand = 'Brand#5' THEN 'otra-' ELSE '' END || p_brand AS id_producto, p_size > 25 AS ean, {_DESCRIPTION} AS descripcion, {_BRAND} AS marca,
       CAST(p_size AS DOUBLE) AS cantidad_presentacion, 'un' AS unidad_medida_presentacion,
       make_date(CAST(y AS INT), 1, 1) AS fecha_vigencia
FROM {{part_years}}""",
}

_FOOTER = "'Ultima actualizacion: ' || CAST(y AS STRING) || '-01-01'"


def _text_columns(names: tuple[str, ...], given: dict[str, str]) -> str:
    return ", ".join(f"{given.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in names)


def _raw_bindings() -> dict[str, str]:
    from gondola.schema import RAW_COLUMNS

    merchant = {
        # One nation declares no merchant in 1996: its stores of that year have none.
        "id_comercio": "CASE WHEN s_nationkey = 7 AND y = 1996 THEN '' "
        "WHEN s_acctbal < 500 THEN CAST(n_regionkey AS STRING) || '.0' "
        "WHEN s_acctbal > 9500 THEN '' ELSE ' ' || CAST(n_regionkey AS STRING) END",
        "id_bandera": "CASE WHEN s_acctbal > 9000 THEN 'x' ELSE CAST(s_nationkey AS STRING) || '.0' END",
        "comercio_cuit": "'30' || CAST(n_nationkey AS STRING)",
        "comercio_razon_social": "'RAZON ' || n_name",
        "comercio_bandera_nombre": "n_name",
        "comercio_bandera_url": "'https://' || lower(n_name) || '.example'",
        "comercio_ultima_actualizacion": "CAST(y AS STRING) || '-01-01'",
        "comercio_version_sepa": "'1.5'",
    }
    store = {
        "id_comercio": "CASE WHEN s_acctbal < 500 THEN CAST(n_regionkey AS STRING) || '.0' "
        "ELSE CAST(n_regionkey AS STRING) END",
        "id_bandera": "CAST(s_nationkey AS STRING)",
        "id_sucursal": "CASE WHEN s_acctbal > 9800 THEN 's/n' ELSE CAST(s_suppkey AS STRING) || '.0' END",
        "sucursales_nombre": "s_name",
        "sucursales_tipo": "CASE WHEN s_nationkey < 10 THEN ' Supermercado ' WHEN s_nationkey < 20 THEN 'WEB' "
        "WHEN s_nationkey = 20 THEN NULL ELSE 'Kiosco ' || CAST(s_nationkey AS STRING) END",
        "sucursales_latitud": "CASE WHEN s_acctbal < 3000 THEN CAST(s_acctbal AS STRING) ELSE 's/d' END",
        "sucursales_longitud": "'-58.25'",
        "sucursales_codigo_postal": "CASE WHEN s_nationkey < 12 THEN '1406.0' ELSE 'C1406' END",
        "sucursales_localidad": "CASE WHEN s_acctbal > 9600 THEN NULL ELSE n_name END",
        "sucursales_provincia": f"CASE WHEN s_nationkey = 4 THEN 'Buenos Aires' ELSE {_PROVINCE} END",
    }
    price = {
        "id_comercio": "CASE WHEN l_returnflag = 'R' THEN CAST(n_regionkey AS STRING) || '.0' "
        "ELSE ' ' || CAST(n_regionkey AS STRING) END",
        "id_bandera": "CASE WHEN l_linenumber = 6 AND l_quantity = 47 THEN 'x' "
        "ELSE CAST(s_nationkey AS STRING) || '.0' END",
        "id_sucursal": "CAST(l_suppkey AS STRING)",
        "id_producto": "CASE WHEN l_tax = 0.01 THEN CAST(l_partkey AS STRING) || '.0' "
        "ELSE CAST(l_partkey AS STRING) END",
        "productos_ean": "CASE WHEN l_linenumber = 5 THEN 'zz' WHEN l_returnflag = 'A' THEN '1' "
        "WHEN l_returnflag = 'N' THEN '0' ELSE 'True' END",
        "productos_descripcion": f"CASE WHEN l_linenumber = 5 AND l_quantity = 46 THEN NULL ELSE {_DESCRIPTION} END",
        "productos_cantidad_presentacion": "CAST(l_quantity AS STRING)",
        "productos_unidad_medida_presentacion": "'un'",
        "productos_marca": _BRAND,
        "productos_precio_lista": "CASE WHEN l_linenumber = 7 AND l_quantity = 50 "
        "THEN '-' || CAST(l_extendedprice AS STRING) "
        "WHEN l_linenumber = 7 AND l_quantity = 49 THEN 'n/d' "
        "WHEN l_linenumber = 7 AND l_quantity = 48 THEN 'NULL' "
        "WHEN l_linenumber = 7 AND l_quantity = 47 THEN '0' "
        "WHEN l_linenumber = 7 AND l_quantity = 46 THEN 'NaN' "
        "WHEN l_linenumber = 7 AND l_quantity = 45 THEN '1e300' "
        "WHEN l_linenumber = 7 AND l_quantity = 44 THEN '10.000043' ELSE CAST(l_extendedprice AS STRING) END",
        "productos_precio_referencia": "CAST(p_retailprice AS STRING)",
        "productos_precio_unitario_promo1": f"CAST({_PROMO} AS STRING)",
        "productos_leyenda_promo1": "CASE WHEN l_discount >= 0.05 THEN 'Promo ' || l_returnflag END",
    }
    day = "make_date(CAST(y AS INT), 1, 1) AS fecha_vigencia"
    # Footers carry a text in the key column only.
    return {
        "raw_comercio": f"""
SELECT {_text_columns(RAW_COLUMNS["comercio"], merchant)}, {day} FROM {_SNAPSHOTS}
UNION ALL
SELECT {_text_columns(RAW_COLUMNS["comercio"], {"id_comercio": _FOOTER})}, {day} FROM {{supplier_years}}""",
        "raw_sucursales": f"""
SELECT {_text_columns(RAW_COLUMNS["sucursales"], store)}, {day} FROM {_SNAPSHOTS}
UNION ALL
SELECT {_text_columns(RAW_COLUMNS["sucursales"], {"id_comercio": _FOOTER})}, {day} FROM {{supplier_years}}""",
        "raw_productos": f"""
SELECT {_text_columns(RAW_COLUMNS["productos"], price)}, {_DAY} AS fecha_vigencia FROM {_SALE}
UNION ALL
SELECT {_text_columns(RAW_COLUMNS["productos"], {"id_producto": _FOOTER})}, {day} FROM {{supplier_years}}""",
    }


BINDINGS = SILVER_BINDINGS | _raw_bindings()

FIRST_YEAR, LAST_YEAR = 1995, 2001
BROADCAST_PARTS = 80_000  # about 10 MB of rows, Spark's own limit for a broadcast
_YEARS = {
    "spark": f"explode(sequence({FIRST_YEAR}, {LAST_YEAR}))",
    "duckdb": f"unnest(range({FIRST_YEAR}, {LAST_YEAR + 1}))",
}


def _resolved(template: str, engine: str) -> str:
    for table in ("supplier", "nation", "part"):
        rows = f"(SELECT *, {_YEARS[engine]} AS y FROM {{{table}}})"
        template = template.replace(f"{{{table}_years}}", rows)
    return template


def duckdb_sql(name: str) -> str:
    return _resolved(BINDINGS[name], "duckdb").format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = _resolved(BINDINGS[name], "spark")
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    if "{lineitem}" in sql and used["part"].count() > BROADCAST_PARTS:
        # Spark goes by the file, which packs to a thirtieth of its rows: they would be broadcast through the driver.
        used["part"] = used["part"].hint("merge")
    return spark.sql(sql, **used)
