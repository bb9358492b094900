"""Cleaning of the three raw tables: typed columns, counted rejects.

Every ``tag_*`` operator keeps all rows and adds ``_reject``: null for a good row,
else the first reason that applies. Counters are then one aggregate over the tag
and the ``clean_*`` operators just filter on it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions import clean_id, is_footer, soft_double, soft_float, soft_int, soft_long, strip
from gondola.schema import raw_columns

REJECT = "_reject"
FOOTER, MISSING, NOT_POSITIVE, ABSURD, ORPHAN = "footer", "validation", "price", "absurd", "integrity"

# No price of a shop is higher; NaN and infinite prices are absurd as well.
HIGHEST_PRICE = 1e12

# Accepted store types, lower case.
STORE_TYPES = (
    "hipermercado",
    "supermercado",
    "autoservicio",
    "tradicional",
    "web",
    "mini",
    "express",
    "super",
    "mayorista",
    "bazar",
    "hiper",
    "hipermercado local",
    "autoservicio exprés",
    "autoservicio expres",
    "tienda virtual",
    "tienda fisica",
)

# Texts of the product code flag.
CODE_FLAG_TRUE = ("1", "True", "true")
CODE_FLAG_FALSE = ("0", "False", "false", "")


def require_columns(df: DataFrame, table: str) -> None:
    missing = [c for c in raw_columns(table) if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns: {', '.join(missing)}")


def drop_footer(df: DataFrame, key: str) -> DataFrame:
    """Without "last update" lines; rows with a null key column stay."""
    return df.filter(~is_footer(F.col(key)))


def strip_nul(c: Column) -> Column:
    return F.translate(c, "\x00", "")


def decode_code_flag(c: Column) -> Column:
    return F.when(c.isin(*CODE_FLAG_TRUE), True).when(c.isin(*CODE_FLAG_FALSE), False)


def _any_null(*names: str) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def _tagged(df: DataFrame, footer_key: str, casts: dict[str, Column], *rules: tuple[Column, str]) -> DataFrame:
    typed = df.withColumn("_footer", is_footer(F.col(footer_key))).withColumns(casts)
    reason = F.when(F.col("_footer"), FOOTER)
    for condition, name in rules:
        reason = reason.when(condition, name)
    return typed.withColumn(REJECT, reason).drop("_footer")


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REJECT).isNull()).drop(REJECT)


def tag_comercio(raw: DataFrame) -> DataFrame:
    require_columns(raw, "comercio")
    texts = {c: strip_nul(F.col(c)) for c in raw_columns("comercio")}
    casts = texts | {
        "id_comercio": clean_id(texts["id_comercio"]),
        "id_bandera": soft_int(texts["id_bandera"]),
        "comercio_cuit": soft_long(texts["comercio_cuit"]),
        "comercio_version_sepa": soft_float(texts["comercio_version_sepa"]),
    }
    no_key = _any_null("id_comercio", "id_bandera") | (F.length("id_comercio") == 0)
    return _tagged(raw, "id_comercio", casts, (no_key, MISSING))


def tag_sucursales(raw: DataFrame) -> DataFrame:
    require_columns(raw, "sucursales")
    casts = {
        "id_comercio": clean_id(F.col("id_comercio")),
        "id_bandera": soft_int(F.col("id_bandera")),
        "id_sucursal": soft_int(F.col("id_sucursal")),
        "sucursales_codigo_postal": soft_int(F.col("sucursales_codigo_postal")),
        "sucursales_tipo": F.lower(strip(F.col("sucursales_tipo"))),
    }
    missing = _any_null(
        "id_comercio", "id_bandera", "id_sucursal", "sucursales_localidad", "sucursales_provincia"
    )
    return _tagged(raw, "id_comercio", casts, (missing, MISSING))


def tag_productos(raw: DataFrame) -> DataFrame:
    require_columns(raw, "productos")
    casts = {
        "id_comercio": clean_id(F.col("id_comercio")),
        "id_bandera": soft_int(F.col("id_bandera")),
        "id_sucursal": soft_int(F.col("id_sucursal")),
        "id_producto": soft_long(F.col("id_producto")),
        "productos_ean": decode_code_flag(F.col("productos_ean")),
        "productos_precio_lista": soft_double(F.col("productos_precio_lista")),
    }
    missing = _any_null(
        "id_comercio",
        "id_bandera",
        "id_sucursal",
        "id_producto",
        "productos_precio_lista",
        "productos_descripcion",
    )
    not_positive = F.col("productos_precio_lista") <= 0
    # Spark orders NaN above every number.
    absurd = F.col("productos_precio_lista") > HIGHEST_PRICE
    return _tagged(raw, "id_producto", casts, (missing, MISSING), (not_positive, NOT_POSITIVE), (absurd, ABSURD))


def clean_comercio(raw: DataFrame) -> DataFrame:
    return kept(tag_comercio(raw))


def clean_sucursales(raw: DataFrame) -> DataFrame:
    return kept(tag_sucursales(raw))


def clean_productos(raw: DataFrame) -> DataFrame:
    return kept(tag_productos(raw))


def unknown_store_types(sucursales: DataFrame, samples: int = 10) -> DataFrame:
    """One row: stores with a type outside the accepted list, how many types, the first few.

    Counts per type come first, so neither the total nor the samples gather store rows.
    """
    tipo = F.col("sucursales_tipo")
    per_type = sucursales.filter(tipo.isNotNull() & ~tipo.isin(*STORE_TYPES)).groupBy(tipo.alias("tipo")).count()
    first = per_type.select("tipo").orderBy("tipo").limit(samples)
    totals = per_type.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("filas"),
        F.count("*").alias("tipos"),
        F.lit(None).cast("string").alias("muestras"),
    )
    shown = first.agg(
        F.lit(None).cast("bigint").alias("filas"),
        F.lit(None).cast("bigint").alias("tipos"),
        F.array_join(F.array_sort(F.collect_list("tipo")), ", ").alias("muestras"),
    )
    return totals.unionByName(shown).agg(
        F.max("filas").alias("filas"), F.max("tipos").alias("tipos"), F.max("muestras").alias("muestras")
    )


def merge_dimension(frames: list[DataFrame], clean) -> DataFrame:
    """Child frames of one dimension: each cleaned, concatenated, whole-row distinct."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [clean(f) for f in frames]
    ).distinct()
