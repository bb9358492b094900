"""Cleaned raw rows to the silver contracts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.functions import soft_double
from gondola.schema import DATE, SILVER_NAMES, silver_schema

# Placeholder for an unknown brand; a province written by name and its code.
UNKNOWN_BRAND = "S/D"
PROVINCE_BY_NAME = {"Buenos Aires": "AR-B"}

LOAD_COLUMNS = (DATE, "scraped_at")


def _cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return c
    if isinstance(source, T.StringType) and isinstance(target, T.DoubleType):
        return soft_double(c)
    return c.try_cast(target)


def project(df: DataFrame, table: str, names: dict[str, str] | None = None, **overrides: Column) -> DataFrame:
    """Contract columns in order, matched by (renamed) name.

    Missing columns become typed nulls, extra ones are dropped. The columns a load
    adds (date, ingest time) are kept when present and left out otherwise.
    """
    source = {(names or {}).get(f.name, f.name): f for f in df.schema.fields}
    out = []
    for field in silver_schema(table).fields:
        if field.name in overrides:
            c = overrides[field.name]
        elif field.name in source:
            given = source[field.name]
            c = _cast(F.col(given.name), given.dataType, field.dataType)
        elif field.name in LOAD_COLUMNS:
            continue
        else:
            c = F.lit(None).cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


def _brand(df: DataFrame) -> dict[str, Column]:
    name = "productos_marca" if "productos_marca" in df.columns else "marca"
    if name not in df.columns:
        return {}
    return {"marca": F.coalesce(F.col(name), F.lit(UNKNOWN_BRAND))}


def _province(df: DataFrame) -> dict[str, Column]:
    name = "sucursales_provincia" if "sucursales_provincia" in df.columns else "provincia"
    if name not in df.columns:
        return {}
    c = F.col(name)
    for text, code in PROVINCE_BY_NAME.items():
        c = F.when(F.col(name) == text, code).otherwise(c)
    return {"provincia": c}


def to_silver_precios(productos: DataFrame) -> DataFrame:
    return project(productos, "precios", SILVER_NAMES["precios"], **_brand(productos))


def to_silver_productos(productos: DataFrame) -> DataFrame:
    """Expects one row per product (see ``distinct_products``)."""
    return project(productos, "dim_productos", SILVER_NAMES["dim_productos"], **_brand(productos))


def to_silver_sucursales(sucursales: DataFrame) -> DataFrame:
    return project(sucursales, "dim_sucursales", SILVER_NAMES["dim_sucursales"], **_province(sucursales))


def to_silver_comercios(comercios: DataFrame) -> DataFrame:
    return project(comercios, "dim_comercios", SILVER_NAMES["dim_comercios"])


def stamp(df: DataFrame, day: str | None = None, scraped_at: datetime | None = None) -> DataFrame:
    """Adds the load columns: a business date given as text, one ingest time for the whole run."""
    if day is not None:
        df = df.withColumn(DATE, F.lit(day).cast("date"))
    if scraped_at is not None:
        if scraped_at.tzinfo is not None:
            scraped_at = scraped_at.replace(tzinfo=None)
        df = df.withColumn("scraped_at", F.lit(scraped_at.isoformat(sep=" ")).cast("timestamp_ntz"))
    return df


def run_time() -> datetime:
    """Ingest time of a run, naive UTC."""
    return datetime.now(timezone.utc).replace(tzinfo=None)
