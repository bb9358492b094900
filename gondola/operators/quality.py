"""Quality rules as data, one aggregate pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.schema import DATE, MERCHANT_KEYS, QUOTE_KEYS, STORE_CURRENT_KEYS, silver_schema

# Columns that may not be null, per model.
NOT_NULL = {
    "stg_precios": ("fecha_vigencia", "id_producto", "id_sucursal", "id_comercio"),
    "stg_dim_comercios": ("id_comercio",),
    "stg_dim_productos": ("id_producto",),
    "stg_dim_sucursales": ("id_sucursal",),
    "fct_price_quotes": ("fecha_vigencia", "id_producto", "id_sucursal", "id_comercio"),
    "dim_productos_current": ("id_producto",),
    "dim_sucursales_current": ("id_sucursal", "id_comercio"),
    "dim_comercios_current": ("id_comercio", "id_bandera"),
    "mart_daily_price_summary": ("fecha_vigencia", "id_producto", "num_observaciones", "precio_promedio"),
    "mart_store_coverage": ("fecha_vigencia", "sucursales_activas", "cadenas_activas"),
    "gold_price_timeseries": ("fecha_vigencia", "id_producto", "provincia"),
    "gold_cross_price_elasticity": ("fecha_vigencia", "id_producto", "cadena_a", "cadena_b"),
    "gold_price_hypothesis": ("fecha_vigencia", "id_producto", "id_sucursal", "provincia", "precio_lista"),
}
UNIQUE = {"dim_productos_current": ("id_producto",)}
GRAIN = {
    "fct_price_quotes": QUOTE_KEYS,
    "gold_price_timeseries": ("fecha_vigencia", "id_producto", "provincia"),
    "dim_sucursales_current": STORE_CURRENT_KEYS,
    "dim_comercios_current": MERCHANT_KEYS,
}

# Columns the silver health report expects filled; price and province domains.
HEALTH_NOT_NULL = {
    "precios": (
        "id_comercio",
        "id_bandera",
        "id_sucursal",
        "id_producto",
        "precio_lista",
        "descripcion",
        "marca",
    ),
    "dim_sucursales": ("id_comercio", "id_bandera", "id_sucursal", "provincia"),
    "dim_comercios": ("id_comercio", "id_bandera", "cuit", "razon_social"),
    "dim_productos": ("id_producto", "descripcion", "marca"),
}
LOW_PRICE = 10.0
PROVINCE_CODE = r"^AR-[A-Z]$"


def _long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(measures), name, value)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_audit(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per column: nulls, all rows, percent of nulls. All columns in one pass."""
    counts = df.groupBy(*by).agg(
        F.count("*").alias("filas"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    pct = F.when(F.col("filas") > 0, F.lit(100.0) * F.col("nulos") / F.col("filas")).otherwise(0.0)
    return _long(counts, [*by, "filas"], columns, "columna", "nulos").withColumn("pct_nulos", pct)


def not_null_failures(tables: dict[str, DataFrame], rules: dict[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """Failing rows per (table, column) rule; zero means the rule holds."""
    checks = []
    for table, columns in rules.items():
        if table in tables:
            counts = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            checks.append(_long(counts.withColumn("tabla", F.lit(table)), ["tabla"], columns, "columna", "fallas"))
    return _union(checks)


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def grain_failures(tables: dict[str, DataFrame], rules: dict[str, Sequence[str]] = GRAIN) -> DataFrame:
    """Number of violating keys and rows per table, zero included."""
    checks = [
        grain_violations(tables[table], keys)
        .agg(F.count("*").alias("claves"), F.coalesce(F.sum("n"), F.lit(0)).alias("filas"))
        .select(F.lit(table).alias("tabla"), "claves", "filas")
        for table, keys in rules.items()
        if table in tables
    ]
    return _union(checks)


def assert_grain(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raises when a key repeats; reads at most one violating key to the driver."""
    bad = grain_violations(df, keys).head(1)
    if bad:
        raise ValueError(f"{name}: key {bad[0].asDict()} repeats")


def duplicate_count(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first per key value: rows minus distinct keys."""
    filas, unicos = F.count("*").alias("filas"), F.count_distinct(key).alias("unicos")
    return df.groupBy(*by).agg(filas, unicos).withColumn("duplicados", F.col("filas") - F.col("unicos"))


def low_price_count(precios: DataFrame, below: float = LOW_PRICE, by: Sequence[str] = ()) -> DataFrame:
    return precios.groupBy(*by).agg(F.count_if(F.col("precio_lista") < below).alias("bajo_minimo"))


def province_domain(sucursales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct provinces, nulls, and rows and values that are no province code."""
    per_value = sucursales.groupBy(*by, "provincia").agg(F.count("*").alias("_n"))
    bad = F.col("provincia").isNotNull() & ~F.col("provincia").rlike(PROVINCE_CODE)
    return per_value.groupBy(*by).agg(
        F.count("provincia").alias("provincias"),
        F.coalesce(F.sum(F.when(F.col("provincia").isNull(), F.col("_n"))), F.lit(0)).alias("nulos"),
        F.count_if(bad).alias("valores_invalidos"),
        F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("filas_invalidas"),
    )


def schema_differences(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """(severity, column, what): a missing column or another type fails, an extra one warns."""
    expected = {f.name: f.dataType for f in silver_schema(table).fields}
    found = {f.name: f.dataType for f in df.schema.fields}
    out = [("error", c, "missing") for c in expected if c not in found]
    out += [
        ("error", c, f"type {found[c].simpleString()}, expected {kind.simpleString()}")
        for c, kind in expected.items()
        if c in found and found[c] != kind
    ]
    return out + [("warn", c, "extra") for c in found if c not in expected]


def sample_rows(df: DataFrame, rows: int = 3, columns: int = 8) -> DataFrame:
    return df.select(*df.columns[:columns]).limit(rows)


def _health_measures(table: str) -> tuple[dict[str, Column], list[str]]:
    """Counters of a table's health report, and which of them only warn."""
    counters = {"filas": F.count("*")}
    counters |= {f"nulos_{c}": F.count_if(F.col(c).isNull()) for c in HEALTH_NOT_NULL[table]}
    if table == "precios":
        counters["bajo_minimo"] = F.count_if(F.col("precio_lista") < LOW_PRICE)
        return counters, ["bajo_minimo"]
    if table == "dim_productos":
        counters["duplicados"] = F.count("*") - F.count_distinct("id_producto")
        return counters, ["duplicados"]
    if table == "dim_sucursales":
        counters["provincia_invalida"] = F.count_if(~F.col("provincia").rlike(PROVINCE_CODE))
    return counters, []


def silver_health(tables: dict[str, DataFrame]) -> DataFrame:
    """Report per date, table and check: severity, value, passed. Errors fail the table.

    Tables are named as in the silver contracts; each is read in one pass.
    """
    report = []
    for table, df in tables.items():
        counters, warnings = _health_measures(table)
        counts = df.groupBy(DATE).agg(*[c.cast("bigint").alias(name) for name, c in counters.items()])
        control, valor = F.col("control"), F.col("valor")
        report.append(
            _long(counts, [DATE], list(counters), "control", "valor").select(
                DATE,
                F.lit(table).alias("tabla"),
                "control",
                F.when(control.isin(warnings), "warn").otherwise("error").alias("severidad"),
                "valor",
                F.when(control == "filas", valor > 0).otherwise(valor == 0).alias("aprobado"),
            )
        )
    return _union(report)


def pruning_effect(table: DataFrame, day: str) -> DataFrame:
    """Data files read with and without a date filter."""

    def files(df: DataFrame, label: str) -> DataFrame:
        paths = df.select(F.col("_metadata.file_path").alias("archivo")).distinct()
        return paths.agg(F.count("*").alias("archivos")).select(F.lit(label).alias("lectura"), "archivos")

    one_day = table.filter(F.col(DATE) == F.lit(day).cast("date"))
    return files(table, "completa").unionByName(files(one_day, "un_dia"))


def describe_table(df: DataFrame, name: str) -> DataFrame:
    """Columns of a table as rows."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType(
        [
            T.StructField("tabla", T.StringType()),
            T.StructField("posicion", T.IntegerType()),
            T.StructField("columna", T.StringType()),
            T.StructField("tipo", T.StringType()),
        ]
    )
    return df.sparkSession.createDataFrame(rows, schema)
