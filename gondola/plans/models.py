"""The incremental models, in build order, and how a run decides what to recompute."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators import facts, marts
from gondola.operators.quality import GRAIN, assert_grain
from gondola.plans.dimensions import maintain
from gondola.plans.sinks import Folder, date_folders, replace_days, upsert
from gondola.schema import DATE, MERCHANT_KEYS, PRODUCT_KEYS, QUOTE_KEYS, SILVER, STORE_CURRENT_KEYS

# Days recomputed for late data, high-water mark of an empty target.
LOOKBACK = timedelta(days=2)
EMPTY_MARK = date(2000, 1, 1)

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class Model:
    name: str
    fact: str
    keys: Sequence[str]
    build: Callable[[Inputs], DataFrame]


DIMENSIONS = {
    "dim_comercios_current": ("dim_comercios", MERCHANT_KEYS),
    "dim_sucursales_current": ("dim_sucursales", STORE_CURRENT_KEYS),
    "dim_productos_current": ("dim_productos", PRODUCT_KEYS),
}

# The time series reads the deduplicated quotes; the other models read the staged fact.
MODELS = (
    Model("fct_price_quotes", "precios", QUOTE_KEYS, lambda i: facts.price_quotes(i["precios"])),
    Model(
        "gold_price_timeseries",
        "fct_price_quotes",
        (DATE, "id_producto", "provincia"),
        lambda i: marts.price_timeseries(i["fct_price_quotes"], i["dim_sucursales_current"]),
    ),
    Model(
        "mart_daily_price_summary",
        "precios",
        ("id_producto", DATE),
        lambda i: marts.daily_price_summary(i["precios"], i["dim_productos_current"]),
    ),
    Model(
        "mart_store_coverage",
        "precios",
        (DATE, "provincia"),
        lambda i: marts.store_coverage(i["precios"], i["dim_sucursales_current"]),
    ),
    Model(
        "gold_cross_price_elasticity",
        "precios",
        (DATE, "id_producto", "cadena_a", "cadena_b"),
        lambda i: marts.cross_price_pairs(
            i["precios"], i["dim_productos_current"], i["dim_comercios_current"]
        ),
    ),
    # A store id is only unique within its merchant, so the key carries id_comercio.
    Model(
        "gold_price_hypothesis",
        "precios",
        (DATE, "id_producto", "id_comercio", "id_sucursal"),
        lambda i: marts.price_hypothesis(
            i["precios"], i["dim_productos_current"], i["dim_sucursales_current"], i["dim_comercios_current"]
        ),
    ),
)


def high_water_mark(target: DataFrame) -> date:
    """Newest date of a target frame, one value."""
    return target.agg(F.max(DATE)).head()[0] or EMPTY_MARK


def written_mark(spark: SparkSession, path: str) -> date:
    """Newest date of a written table, from its partition folders; no file is opened."""
    return max(map(date.fromisoformat, date_folders(Folder(spark, path))), default=EMPTY_MARK)


def incremental_rows(source: DataFrame, mark: date, lookback: timedelta = LOOKBACK) -> DataFrame:
    """Source rows a run recomputes. The bound is a literal, so date partitions prune."""
    return source.filter(F.col(DATE) >= F.lit((mark - lookback).isoformat()).cast("date"))


def table_path(root: str, name: str) -> str:
    return f"{root}/silver/{name}" if name in SILVER else f"{root}/gold/{name}"


def run_model(spark: SparkSession, model: Model, inputs: Inputs, path: str, full: bool = False) -> DataFrame:
    """First run builds all dates; later runs upsert from the high-water mark on.

    Returns the table as written, also when it has no rows yet.
    """
    fact = inputs[model.fact]
    incremental = not full and Folder(spark, path).exists()
    if incremental:
        fact = incremental_rows(fact, written_mark(spark, path))
    rows = model.build(inputs | {model.fact: fact})
    if incremental:
        upsert(rows, path, model.keys, model.name)
    else:
        replace_days(rows, path, model.name, whole=True)
    return spark.read.schema(rows.schema).parquet(path)


def build_all(spark: SparkSession, root: str, full: bool = False, start: str | None = None) -> dict[str, DataFrame]:
    """Current dimensions, then every model in order; each table is read back for the next.

    Dimensions are kept up to date from the snapshots that changed since the last run. The declared grains are asserted on what was written. Returns the tables built.
    """
    inputs: Inputs = {n: spark.read.schema(SILVER[n]).parquet(table_path(root, n)) for n in SILVER}
    inputs["precios"] = facts.stage_precios(inputs["precios"], start)
    for name, (snapshots, keys) in DIMENSIONS.items():
        path, schema = table_path(root, name), inputs[snapshots].schema
        rows = maintain(spark, table_path(root, snapshots), schema, keys, f"{root}/gold/_state/{name}", full)
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        inputs[name] = spark.read.schema(rows.schema).parquet(path)
    for model in MODELS:
        inputs[model.name] = run_model(spark, model, inputs, table_path(root, model.name), full)
    for name, keys in GRAIN.items():
        assert_grain(inputs[name], keys, name)
    return {name: df for name, df in inputs.items() if name not in SILVER}
