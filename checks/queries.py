"""One registered query per operator: the library applied to the bound tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from datetime import date, datetime
from typing import TypeVar

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import FIRST_YEAR, LAST_YEAR, bind, table
from gondola.functions import (
    business_date,
    categorize_product,
    clean_description,
    soft_double,
    soft_int,
    soft_long,
    weekday_name,
)
from gondola.operators import adhoc, audit, clean, dims, facts, freshness, integrity, marts, quality, silver
from gondola.plans import daily, dimensions, models, query, sinks
from gondola.schema import DATE, MERCHANT_KEYS, RAW_TABLES, STORE_CURRENT_KEYS, STORE_KEYS, raw_columns, silver_schema
from gondola.session import scratch_dir, shuffles_removed
from gondola.sources import archives, pages, raw_csv, tables
from gondola.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIME = datetime(2002, 1, 1, 12, 0, 0)
AS_OF = date(2001, 11, 5)
FIRST_DAY, LAST_DAY = date(FIRST_YEAR, 1, 1), date(LAST_YEAR, 1, 1)


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_written: dict = {}
T = TypeVar("T")


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[], T]) -> T:
    """Tables the queries share, written once per application and read back.

    Written tables have a size Spark knows, so a side is broadcast only when it is small.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def _precios(spark: SparkSession, sf: str) -> DataFrame:
    """The silver fact in the layout the daily load writes."""

    def build() -> DataFrame:
        path = scratch_dir(spark, "precios")
        sinks.replace_days(bind(spark, sf, "precios"), path, "precios")
        return tables.scan(spark, path, silver_schema("precios"))

    return _once(spark, sf, "precios", build)


def _bronze_root(spark: SparkSession, sf: str, only: tuple[str, ...] = RAW_TABLES) -> str:
    """Bronze tables of all days in the layout the daily load writes."""

    def build() -> str:
        path = scratch_dir(spark, "bronze")
        sinks.write_bronze_range({t: bind(spark, sf, f"raw_{t}") for t in only}, path)
        return path

    return _once(spark, sf, f"bronze-{'-'.join(only)}", build)


def _raw_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One bronze table; the others are not built for it."""
    root = _bronze_root(spark, sf, (name,))
    return tables.read_bronze(spark, sinks.bronze_path(root, name), name).drop(*tables.DAY_PARTS)


def _raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Raw price rows for jobs that write text files: written where they come up, without a shuffle to the days
    of a bronze table that nobody reads."""

    def build() -> DataFrame:
        path, rows = scratch_dir(spark, "raw-prices"), bind(spark, sf, "raw_productos").select(*raw_columns("productos"))
        rows.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return _once(spark, sf, "raw-prices", build)


def _raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: _raw_table(spark, sf, t) for t in RAW_TABLES}


def _table(spark: SparkSession, sf: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    def build() -> DataFrame:
        path, df = scratch_dir(spark, name), rows()
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return _once(spark, sf, name, build)


def _current(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The current dimensions as the models read them: written tables."""
    built = {
        "productos": dim_productos_current,
        "sucursales": dim_sucursales_current,
        "comercios": dim_comercios_current,
    }
    return {name: _table(spark, sf, f"{name}_current", lambda q=q: q(spark, sf)) for name, q in built.items()}


def _quotes(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplicated fact as the time series model reads it: a table partitioned by date."""

    def build() -> DataFrame:
        path, rows = scratch_dir(spark, "quotes"), fct_price_quotes(spark, sf)
        sinks.replace_days(rows, path, "fct_price_quotes")
        return tables.scan(spark, path, rows.schema)

    return _once(spark, sf, "quotes", build)


def _stores_by_banner(spark: SparkSession, sf: str) -> DataFrame:
    return _table(
        spark,
        sf,
        "sucursales_by_banner",
        lambda: dims.sucursales_current(bind(spark, sf, "dim_sucursales"), STORE_KEYS),
    )


# --- dimensions and facts -----------------------------------------------------


@registered
def dim_comercios_current(spark, sf):
    return dims.comercios_current(bind(spark, sf, "dim_comercios"))


@registered
def dim_sucursales_current(spark, sf):
    return dims.sucursales_current(bind(spark, sf, "dim_sucursales"))


@registered
def dim_productos_current(spark, sf):
    return dims.productos_current(bind(spark, sf, "dim_productos"))


@registered
def stg_precios(spark, sf):
    return facts.stage_precios(_precios(spark, sf))


@registered
def fct_price_quotes(spark, sf):
    return facts.price_quotes(facts.stage_precios(_precios(spark, sf)))


@registered
def latest_prices(spark, sf):
    stores = _stores_by_banner(spark, sf)
    return facts.latest_prices(_precios(spark, sf), stores, _current(spark, sf)["comercios"])


@registered
def price_comparison(spark, sf):
    c = _current(spark, sf)
    stores = _stores_by_banner(spark, sf)
    return facts.price_comparison(
        _precios(spark, sf), c["productos"], stores, c["comercios"], AS_OF, days_back=1500
    )


# --- marts and gold -----------------------------------------------------------


@registered
def mart_daily_price_summary(spark, sf):
    return marts.daily_price_summary(_precios(spark, sf), _current(spark, sf)["productos"])


@registered
def mart_store_coverage(spark, sf):
    return marts.store_coverage(_precios(spark, sf), _current(spark, sf)["sucursales"])


@registered
def gold_price_timeseries(spark, sf):
    series = marts.price_timeseries(_quotes(spark, sf), _current(spark, sf)["sucursales"])
    # The sample deviation is the one measure whose last bits differ between engines.
    return series.withColumn("precio_desvio", F.round("precio_desvio", 4))


@registered
def chain_avg_prices(spark, sf):
    c = _current(spark, sf)
    return marts.chain_avg_prices(_precios(spark, sf), c["productos"], c["comercios"])


@registered
def gold_cross_price_elasticity(spark, sf):
    c = _current(spark, sf)
    pairs = marts.cross_price_pairs(_precios(spark, sf), c["productos"], c["comercios"])
    return pairs.withColumns({c: F.round(c, 6) for c in ("ln_precio_a", "ln_precio_b")})


@registered
def gold_price_hypothesis(spark, sf):
    c = _current(spark, sf)
    return marts.price_hypothesis(_precios(spark, sf), c["productos"], c["sucursales"], c["comercios"])


@registered
def approx_median(spark, sf):
    """Series with approximate medians, next to the range they must lie in."""
    c = _current(spark, sf)["sucursales"]
    series = marts.price_timeseries(_quotes(spark, sf), c, approx_median=True)
    return series.select(DATE, "id_producto", "provincia", "precio_mediana", "precio_min", "precio_max")


# --- scalar functions ---------------------------------------------------------


@registered
def clean_description_query(spark, sf):
    p = bind(spark, sf, "dim_productos")
    return p.select(DATE, "descripcion", clean_description(F.col("descripcion")).alias("descripcion_clean"))


QUERIES["clean_description"] = QUERIES.pop("clean_description_query")


@registered
def categorize_product_query(spark, sf):
    p = bind(spark, sf, "dim_productos").withColumn("limpia", clean_description(F.col("descripcion")))
    return p.select(DATE, "limpia", categorize_product(F.col("limpia")).alias("categoria"))


QUERIES["categorize_product"] = QUERIES.pop("categorize_product_query")


@registered
def soft_cast(spark, sf):
    raw = _raw_table(spark, sf, "productos")
    return raw.select(
        DATE,
        "id_producto",
        "productos_precio_lista",
        soft_int(F.col("id_bandera")).alias("bandera"),
        soft_long(F.col("id_producto")).alias("producto"),
        soft_double(F.col("productos_precio_lista")).alias("precio"),
        soft_int(F.col("productos_precio_lista")).alias("precio_entero"),
    )


@registered
def business_date_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    day = business_date(F.col("o_orderdate"))
    return orders.select("o_orderkey", day.alias("dia"), weekday_name(day).alias("nombre"))


QUERIES["business_date"] = QUERIES.pop("business_date_query")


@registered
def date_window_scan(spark, sf):
    path = scratch_dir(spark, "window")
    sinks.replace_days(_precios(spark, sf), path, "precios")
    rows = facts.date_window(tables.scan(spark, path, silver_schema("precios")), date(2000, 1, 3))
    return rows.groupBy(DATE, "id_producto").agg(F.count("*").alias("filas"), F.max("precio_lista").alias("maximo"))


# --- cleaning and silver --------------------------------------------------------


@registered
def footer_filter(spark, sf):
    rows = clean.drop_footer(_raw_table(spark, sf, "productos"), "id_producto")
    return rows.groupBy(DATE).agg(F.count("*").alias("filas"), F.count("id_producto").alias("con_producto"))


@registered
def clean_comercio(spark, sf):
    return clean.clean_comercio(_raw_table(spark, sf, "comercio"))


@registered
def clean_sucursales(spark, sf):
    return clean.clean_sucursales(_raw_table(spark, sf, "sucursales"))


@registered
def clean_productos(spark, sf):
    return clean.clean_productos(_raw_table(spark, sf, "productos"))


@registered
def store_type_unknown(spark, sf):
    return clean.unknown_store_types(clean.clean_sucursales(_raw_table(spark, sf, "sucursales")))


@registered
def merged_dimensions(spark, sf):
    """Every package repeats its merchant's row; two frames with other column orders repeat all."""
    raw = _raw_table(spark, sf, "comercio")
    return clean.merge_dimension([raw, raw.select(*reversed(raw.columns))], clean.clean_comercio)


@registered
def to_silver_precios(spark, sf):
    return silver.to_silver_precios(clean.clean_productos(_raw_table(spark, sf, "productos")))


@registered
def to_silver_sucursales(spark, sf):
    return silver.to_silver_sucursales(clean.clean_sucursales(_raw_table(spark, sf, "sucursales")))


@registered
def to_silver_comercios(spark, sf):
    return silver.to_silver_comercios(clean.clean_comercio(_raw_table(spark, sf, "comercio")))


@registered
def distinct_products(spark, sf):
    return integrity.distinct_products(to_silver_productos(spark, sf))


@registered
def to_silver_productos(spark, sf):
    return silver.to_silver_productos(clean.clean_productos(_raw_table(spark, sf, "productos")))


@registered
def orphan_stores(spark, sf):
    stores, merchants = clean_sucursales(spark, sf), clean_comercio(spark, sf)
    return integrity.orphan_keys(stores, merchants, [DATE, *MERCHANT_KEYS])


@registered
def semi_stores(spark, sf):
    merchants = clean_comercio(spark, sf)
    return integrity.keep_matching(clean_sucursales(spark, sf), merchants, MERCHANT_KEYS, spare_uncovered=True)


@registered
def orphan_prices(spark, sf):
    return integrity.orphan_keys(clean_productos(spark, sf), semi_stores(spark, sf), [DATE, *STORE_KEYS])


@registered
def semi_prices(spark, sf):
    return integrity.keep_matching(clean_productos(spark, sf), semi_stores(spark, sf), STORE_KEYS, spare_uncovered=True)


@registered
def drop_stats(spark, sf):
    return audit.drop_stats(daily.validated(_raw(spark, sf))["productos"])


# --- reports --------------------------------------------------------------------


@registered
def table_counts(spark, sf):
    c = _current(spark, sf)
    return adhoc.table_counts(
        {
            "Comercios": c["comercios"],
            "Sucursales": c["sucursales"],
            "Productos Master": c["productos"],
            "Precios (Fact)": _precios(spark, sf),
        }
    )


@registered
def prices_by_banner(spark, sf):
    return adhoc.prices_by_banner(_precios(spark, sf), _current(spark, sf)["comercios"])


@registered
def price_outliers(spark, sf):
    c = _current(spark, sf)
    return adhoc.price_outliers(_precios(spark, sf), c["productos"], c["comercios"])


@registered
def product_chain_coverage(spark, sf):
    c = _current(spark, sf)
    return adhoc.product_chain_coverage(_precios(spark, sf), c["productos"], c["comercios"])


@registered
def latest_scrape(spark, sf):
    return adhoc.latest_scrape(_precios(spark, sf))


@registered
def basket_cost(spark, sf):
    """Each part type is a basket of its brands; stores price the brands."""
    baskets = (
        table(spark, sf, "part")
        .groupBy(F.col("p_type").alias("basket_id"), F.col("p_brand").alias("id_producto"))
        .agg(F.max("p_size").alias("cantidad"))
    )
    stores = _stores_by_banner(spark, sf)
    prices = facts.latest_prices(
        _precios(spark, sf),
        stores,
        _current(spark, sf)["comercios"],
        columns=(*STORE_KEYS, "id_producto", "precio_lista"),
        products=baskets.select("id_producto").distinct(),
    )
    return adhoc.basket_cost(prices, baskets)


# --- audits and quality -----------------------------------------------------------


@registered
def audit_silver(spark, sf):
    return audit.silver_audit(drop_stats(spark, sf), RUN_TIME)


@registered
def audit_latest(spark, sf):
    return audit.audit_latest(audit_silver(spark, sf), limit=3)


@registered
def dq_null_audit(spark, sf):
    return quality.null_audit(_precios(spark, sf), quality.HEALTH_NOT_NULL["precios"], by=[DATE])


@registered
def dq_duplicate_products(spark, sf):
    return quality.duplicate_count(bind(spark, sf, "dim_productos"), "id_producto", by=[DATE])


@registered
def dq_province(spark, sf):
    """Provinces as declared, before cleaning: names and footers included."""
    return quality.province_domain(
        _raw_table(spark, sf, "sucursales").withColumnRenamed("sucursales_provincia", "provincia"), by=[DATE]
    )


@registered
def dq_low_price(spark, sf):
    return quality.low_price_count(_precios(spark, sf), by=[DATE])


def _models(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    c = _current(spark, sf)
    return {
        "stg_precios": stg_precios(spark, sf),
        "stg_dim_comercios": bind(spark, sf, "dim_comercios"),
        "stg_dim_productos": bind(spark, sf, "dim_productos"),
        "stg_dim_sucursales": bind(spark, sf, "dim_sucursales"),
        "fct_price_quotes": _quotes(spark, sf),
        "dim_productos_current": c["productos"],
        "dim_sucursales_current": c["sucursales"],
        "dim_comercios_current": c["comercios"],
        "mart_daily_price_summary": mart_daily_price_summary(spark, sf),
        "mart_store_coverage": mart_store_coverage(spark, sf),
        "gold_price_timeseries": gold_price_timeseries(spark, sf),
        "gold_cross_price_elasticity": gold_cross_price_elasticity(spark, sf),
        "gold_price_hypothesis": gold_price_hypothesis(spark, sf),
    }


@registered
def dq_not_null(spark, sf):
    return quality.not_null_failures(_models(spark, sf))


@registered
def dq_unique(spark, sf):
    """Keys that repeat in the product snapshots, which hold many rows per product."""
    return quality.grain_violations(bind(spark, sf, "dim_productos"), quality.UNIQUE["dim_productos_current"])


@registered
def dq_grain(spark, sf):
    """Grain checks of the models, and of the undeduplicated fact at the same grain."""
    checked = {name: df for name, df in _models(spark, sf).items() if name in quality.GRAIN}
    fact = {"stg_precios": stg_precios(spark, sf)}
    rules = quality.GRAIN | {"stg_precios": quality.GRAIN["fct_price_quotes"]}
    return quality.grain_failures(checked | fact, rules)


@registered
def silver_health(spark, sf):
    return quality.silver_health(_lake(spark, sf))


# --- files: raw text, tables, commits ------------------------------------------------


def _write_lines(df: DataFrame, columns: list[str], path: str, header: str | None = None) -> None:
    """Delimited text files with a header line each; null becomes an empty field."""
    line = F.array_join(F.array(*[F.col(c) for c in columns]), "|", "")
    name = header or "|".join(columns)
    (
        df.select(line.alias(name))
        .write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@registered
def raw_csv_clean(spark, sf):
    path = scratch_dir(spark, "raw")
    _write_lines(_raw_prices(spark, sf), list(raw_columns("productos")), path)
    return raw_csv.read_raw_csv(spark, path)


@registered
def align_by_name(spark, sf):
    """Four headers: file order with a byte order mark, reversed with blanks, promotions left out, no banner."""
    path = scratch_dir(spark, "mixed")
    raw = _raw_prices(spark, sf)
    names = list(raw_columns("productos"))
    code = F.coalesce("productos_ean", F.lit(""))
    few = [c for c in names if "promo" not in c]
    _write_lines(raw.filter(code == "1"), names, f"{path}/a", raw_csv.BOM + "|".join(names))
    _write_lines(raw.filter(code == "0"), names[::-1], f"{path}/b", " | ".join(names[::-1]))
    other = raw.filter(~code.isin("0", "1")).withColumn("extra", F.lit("sobra"))
    third = F.coalesce(F.col("id_comercio"), F.lit("")).endswith("3")
    _write_lines(other.filter(~third), ["extra", *few], f"{path}/c")
    _write_lines(other.filter(third), [c for c in few[::-1] if c != "id_bandera"], f"{path}/d")
    return raw_csv.read_by_name(spark, [f"{path}/{p}" for p in "abcd"], "productos")


@registered
def merged_schema_scan(spark, sf):
    """Files of different width under one table, read by name with their date partitions."""
    path = scratch_dir(spark, "merged")
    precios = _precios(spark, sf).select(DATE, "id_producto", "precio_lista", "precio_promo1")
    early = F.col(DATE) < "1998-01-01"
    precios.filter(early).drop("precio_promo1").write.partitionBy(DATE).parquet(path)
    precios.filter(~early).write.mode("append").partitionBy(DATE).parquet(path)
    return tables.scan(spark, path)


@registered
def silver_day_replace(spark, sf):
    """All dates loaded, one date loaded again twice, changed: each date holds its last load."""
    path = scratch_dir(spark, "silver")
    rows = silver.stamp(bind(spark, sf, "precios").drop("scraped_at"), scraped_at=RUN_TIME)
    sinks.replace_days(rows, path, "precios")
    # The date is read back once and staged: a load cannot read the table it replaces, nor need the source be joined again.
    first = tables.scan(spark, path, silver_schema("precios")).filter(F.col(DATE) == "1999-01-01")
    stage = scratch_dir(spark, "silver-again")
    first.withColumn("precio_lista", F.col("precio_lista") + 1).write.option("compression", "zstd").parquet(stage)
    again = spark.read.schema(first.schema).parquet(stage)
    for _ in range(2):
        sinks.replace_days(again, path, "precios")
    return tables.scan(spark, path, silver_schema("precios"))


@registered
def dim_snapshot_replace(spark, sf):
    path = scratch_dir(spark, "snapshots")
    rows = bind(spark, sf, "dim_sucursales")
    sinks.replace_days(rows, path)
    again = rows.filter(F.col(DATE) == "1999-01-01").withColumn("nombre", F.upper("nombre"))
    sinks.replace_days(again, path)
    return tables.scan(spark, path, silver_schema("dim_sucursales"))


@registered
def dim_current_maintained(spark, sf):
    """Current stores kept through two loads, a reload of 2000 and the withdrawal of 2001."""
    path = scratch_dir(spark, "maintained")
    rows, schema = bind(spark, sf, "dim_sucursales"), silver_schema("dim_sucursales")
    reloaded = rows.filter(F.col(DATE) == "2000-01-01").withColumn("nombre", F.upper("nombre"))

    def current() -> DataFrame:
        return dimensions.maintain(spark, f"{path}/snapshots", schema, STORE_CURRENT_KEYS, f"{path}/state")

    for load in (rows.filter(F.col(DATE) < "1998-01-01"), rows.filter(F.col(DATE) >= "1998-01-01"), reloaded):
        sinks.replace_days(load, f"{path}/snapshots")
        current()
    sinks.drop_days(spark, f"{path}/snapshots", [LAST_DAY])
    return current()


@registered
def bronze_partition_scan(spark, sf):
    rows = daily.bronze_rows(spark, _bronze_root(spark, sf), "productos", date(1997, 1, 1), date(1999, 12, 31))
    return rows.groupBy("year", "month", "day").agg(
        F.count("*").alias("filas"), F.count("productos_precio_lista").alias("con_precio")
    )


@registered
def bronze_commit(spark, sf):
    """A day is committed, then a rebuild without products fails and leaves it as it was."""
    path = scratch_dir(spark, "commit")
    day = LAST_DAY
    frames = {t: bind(spark, sf, f"raw_{t}").filter(F.col(DATE) == str(day)).drop(DATE) for t in RAW_TABLES}
    sinks.write_bronze_day(frames, path, day)
    sinks.write_bronze_day(frames | {"productos": frames["productos"].filter("false")}, path, day)
    if not sinks.day_exists(spark, path, day):
        raise AssertionError("committed day is gone")
    return adhoc.table_counts({t: daily.bronze_rows(spark, path, t, day, day) for t in RAW_TABLES})


@registered
def bronze_range_commit(spark, sf):
    """A range of two days is committed, a second build of it fails on its last day, a third replaces one day."""
    path = scratch_dir(spark, "range")
    days = [date(2000, 1, 1), LAST_DAY]
    both = {t: df.filter(F.col(DATE).isin(days)) for t, df in _raw(spark, sf).items()}
    sinks.write_bronze_range(both, path)
    broken = F.when(F.col(DATE) == LAST_DAY, F.raise_error(F.lit("broken")).cast("string")).otherwise("x")
    try:
        sinks.write_bronze_range(both | {"productos": both["productos"].withColumn("id_producto", broken)}, path)
    except Exception as e:
        if "broken" not in str(e):
            raise
    last = {t: df.filter(F.col(DATE) == LAST_DAY) for t, df in both.items()}
    sinks.write_bronze_range(last | {"productos": last["productos"].withColumn("productos_marca", F.lit("otra"))}, path)
    rows = {t: daily.bronze_rows(spark, path, t, *days) for t in RAW_TABLES}
    brand = F.lit(None).cast("string")
    counted = [
        df.withColumn("marca", F.col("productos_marca") if t == "productos" else brand)
        .groupBy(F.lit(t).alias("tabla"), DATE)
        .agg(F.count("*").alias("filas"), F.count_if(F.col("marca") == "otra").alias("otras"))
        for t, df in rows.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@registered
def retention_plan(spark, sf):
    return sinks.retention_plan(_precios(spark, sf), AS_OF, keep_days=1500)


# --- incremental ----------------------------------------------------------------------


@registered
def incremental_window(spark, sf):
    """Rows a run recomputes when the target ends in 1999."""
    staged = stg_precios(spark, sf)
    mark = models.high_water_mark(staged.filter(F.col("scraped_at") < "2000-01-01").select(DATE))
    rows = models.incremental_rows(staged, mark)
    return rows.groupBy(DATE).agg(F.count("*").alias("filas"))


@registered
def incremental_upsert(spark, sf):
    """Coverage built from what was scraped by mid 1999, then brought up to date."""
    path = scratch_dir(spark, "upsert")
    staged, stores = stg_precios(spark, sf), _current(spark, sf)["sucursales"]
    model = next(m for m in models.MODELS if m.name == "mart_store_coverage")
    early = staged.filter(F.col("scraped_at") < "1999-07-01")
    for rows in (early, staged, staged):
        models.run_model(spark, model, {"precios": rows, "dim_sucursales_current": stores}, path)
    return spark.read.schema(mart_store_coverage(spark, sf).schema).parquet(path)


@registered
def backfill_range(spark, sf):
    """A range of bronze days loaded to silver in one run; counters per day."""
    path = scratch_dir(spark, "backfill")
    days = (date(1996, 1, 1), date(2000, 12, 31))
    daily.load_days(spark, path, *days, scraped_at=RUN_TIME, bronze_root=_bronze_root(spark, sf))
    rows = spark.read.schema(audit.AUDIT_SILVER).parquet(f"{path}/audit/silver")
    fact = tables.scan(spark, models.table_path(path, "precios"), silver_schema("precios"))
    loaded = fact.groupBy(DATE).agg(
        F.count("*").alias("filas"), F.count_distinct("id_producto").alias("productos")
    )
    products = tables.scan(spark, models.table_path(path, "dim_productos"), silver_schema("dim_productos"))
    dim = products.groupBy(DATE).agg(F.count("*").alias("dim_productos"))
    return rows.drop("ingested_at", "table_type").join(loaded, DATE).join(dim, DATE)


@registered
def stream_ingest_query(spark, sf):
    """Bronze files arrive in two waves; the stream runs after each."""
    path = scratch_dir(spark, "stream")
    raw = {t: _raw_table(spark, sf, t) for t in ("comercio", "sucursales")} | {"productos": bind(spark, sf, "raw_productos")}
    parts = daily.validated(raw)
    sinks.replace_days(silver.to_silver_sucursales(parts["sucursales"]), models.table_path(path, "dim_sucursales"))
    waves = (F.col(DATE) < "1999-01-01", F.col(DATE) >= "1999-01-01")
    for wave in waves:
        arrived = tables.with_day_parts(raw["productos"].filter(wave)).drop(DATE)
        arrived.write.mode("append").partitionBy(*tables.DAY_PARTS).parquet(f"{path}/arrivals")
        stream_ingest(spark, f"{path}/arrivals", path, f"{path}/progress").awaitTermination()
    fact = tables.scan(spark, models.table_path(path, "precios"), silver_schema("precios"))
    return fact.groupBy(DATE).agg(F.count("*").alias("filas"), F.count_distinct("id_producto").alias("productos"))


QUERIES["stream_ingest"] = QUERIES.pop("stream_ingest_query")


# --- archives -------------------------------------------------------------------------

TARGET_DAY = date(1998, 1, 2)


SLICE_LINES = 20_000_000  # price lines whose shuffles lie on disk at a time


def master_archives(spark: SparkSession, sf: str, part: int = 0, parts: int = 1) -> DataFrame:
    """One master archive per supplier with a child per ship year, as (path, content); those of one of ``parts``
    disjoint sets of suppliers.

    Some children are broken, lack a file or carry no footer date. A supplier's lines are
    a few hundred at any scale factor.
    """
    wanted = F.pmod(F.xxhash64("s_suppkey"), F.lit(parts)) == part if parts > 1 else F.lit(True)
    products = list(raw_columns("productos"))
    # Straight from the source: packing goes by store, so the days of a bronze table would be one shuffle more.
    lines = bind(spark, sf, "raw_productos").filter(F.col("id_sucursal").isNotNull()).select(
        F.col("id_sucursal").cast("bigint").alias("s_suppkey"),
        F.year(DATE).alias("y"),
        F.array_join(F.array(*[F.col(c) for c in products]), "|", "").alias("line"),
    ).filter(wanted)
    stores = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal").filter(wanted)
    header = "|".join(products)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        by_year = {int(y): sorted(g["line"].dropna()) for y, g in pdf.groupby("y")}
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as master:
            for y in range(FIRST_YEAR, LAST_YEAR + 1):
                master.writestr(
                    f"dia/child_{y}.zip",
                    _child(header, by_year.get(y, []), y, int(first["s_nationkey"]), float(first["s_acctbal"])),
                )
        return pd.DataFrame({"path": [f"master_{int(first['s_suppkey'])}.zip"], "content": [buffer.getvalue()]})

    # A built line counts as one short text in Spark's estimate, so without the hint all lines would be
    # collected and broadcast; both sides go by the key the packing groups by anyway.
    return (
        stores.join(lines.hint("merge"), "s_suppkey", "left")
        .groupBy("s_suppkey")
        .applyInPandas(pack, "path string, content binary")
    )


def _child(header: str, lines: list[str], year: int, nation: int, balance: float) -> bytes:
    if balance < 0 and year == FIRST_YEAR:
        return b"not an archive"
    footer = [] if nation < 5 and year >= 2000 else [f"Última actualización: {year}-01-01"]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as child:
        child.writestr("comercio.csv", "\n".join(["﻿id_comercio|id_bandera", f"1|{nation}", *footer]))
        if not (balance > 8000 and year == 1996):
            child.writestr("sucursales.csv", f"id_comercio|id_bandera|id_sucursal\n1|{nation}|7\n")
        child.writestr("productos.csv", "\n".join([header, *lines]))
    content = bytearray(buffer.getvalue())
    if balance < 0 and year == 1997:  # the directory is readable, the last member's data is not
        with zipfile.ZipFile(io.BytesIO(buffer.getvalue())) as whole:
            at = whole.getinfo("productos.csv").header_offset + 30 + len("productos.csv")
        content[at : at + 4] = b"\xff\xff\xff\xff"
    return bytes(content)


def _masters(spark: SparkSession, sf: str) -> DataFrame:
    """The master archives, written a set of suppliers at a time: the lines of the others are not shuffled yet, and
    the shuffles of those done are gone."""

    def build() -> DataFrame:
        path, parts = scratch_dir(spark, "masters"), -(-table(spark, sf, "lineitem").count() // SLICE_LINES) or 1
        for part in range(parts):
            masters = master_archives(spark, sf, part, parts)
            with shuffles_removed(spark):
                masters.write.mode("append").parquet(path)
        return spark.read.schema(masters.schema).parquet(path)

    return _once(spark, sf, "masters", build)


def _children(spark: SparkSession, sf: str) -> DataFrame:
    return archives.split_masters(_masters(spark, sf), "child_*.zip")


def _dated(children: DataFrame) -> DataFrame:
    merchant = archives.member_lines(children, ("comercio",), complete_only=False)
    dated = freshness.child_dates(archives.child_status(children), merchant)
    return dated.withColumn("target_date", F.lit(TARGET_DAY))


@registered
def archive_members(spark, sf):
    """Data lines per child and table."""
    lines = archives.member_lines(_children(spark, sf))
    return lines.groupBy("package", "child", "table").agg(F.count("*").alias("lineas"))


@registered
def package_completeness(spark, sf):
    return freshness.package_completeness(_dated(_children(spark, sf)))


@registered
def package_freshness(spark, sf):
    return freshness.package_vote(_dated(_children(spark, sf)))


@registered
def bronze_build(spark, sf):
    """Price files of all archives to one zstd bronze table, read back."""
    path = scratch_dir(spark, "build")
    lines = archives.member_lines(_children(spark, sf), ("productos",))
    rows = archives.table_rows(lines, "productos")
    # Children are spread already, as archives; spreading their rows as well takes several times the disk.
    with shuffles_removed(spark):
        rows.write.option("maxRecordsPerFile", sinks.ROWS_PER_FILE).option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@registered
def bronze_build_all(spark, sf):
    """All three tables of all archives, committed as one range of days and read back."""
    path = scratch_dir(spark, "build-all")
    year = F.regexp_extract("child", r"child_([0-9]{4})", 1)
    frames = {}
    for t in RAW_TABLES:
        rows = archives.table_rows(archives.member_lines(_children(spark, sf), (t,)), t)
        frames[t] = rows.withColumn(DATE, F.make_date(year.cast("int"), F.lit(1), F.lit(1))).select(*raw_columns(t), DATE)
    sinks.write_bronze_range(frames, path)
    counted = [
        daily.bronze_rows(spark, path, t, FIRST_DAY, LAST_DAY)
        .groupBy(F.lit(t).alias("tabla"), DATE)
        .agg(F.count("*").alias("filas"), F.count("id_bandera").alias("banderas"))
        for t in RAW_TABLES
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@registered
def audit_bronze(spark, sf):
    """Audit rows of all days: what was read, what was written, and the package counters."""
    given = {t: bind(spark, sf, f"raw_{t}") for t in RAW_TABLES}
    dated = _dated(_children(spark, sf)).withColumn(
        DATE, F.make_date(F.regexp_extract("child", r"(\d{4})", 1).cast("int"), F.lit(1), F.lit(1))
    )
    per_day = freshness.package_completeness(dated.drop("package").withColumnRenamed(DATE, "package"))
    packages = per_day.select(F.col("package").alias(DATE), "malformed", "stale", "unknown")
    return audit.bronze_audit(
        audit.table_volume(given), audit.table_volume(_raw(spark, sf)), packages, RUN_TIME, "masters", "bronze"
    )


# --- pages ------------------------------------------------------------------------------


@registered
def page_links(spark, sf):
    """Every link of the page table that looks like an archive, and how many links each page has."""
    all_pages = table(spark, sf, "pages")
    links = F.size(F.regexp_extract_all("html", F.lit(pages.HREF), 1)).cast("bigint").alias("enlaces")
    found = pages.page_links(all_pages).groupBy("page_id").agg(F.count("*").alias("archivos"))
    return all_pages.select("page_id", links).join(found, "page_id", "left")


@registered
def package_links(spark, sf):
    """One portal page per supplier with a package block per ship year, plus the given pages,
    which have none."""
    y = F.col("y").cast("string")
    suppliers = table(spark, sf, "supplier").withColumn(
        "y", F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR)))
    )
    action = F.when(F.col("y") < 1998, F.concat(F.lit('<a href="/files/s'), "s_suppkey", F.lit("_"), y, F.lit('.zip">Bajar</a>')))
    action = action.when(F.col("y") < 2000, F.concat(F.lit('<a href="/go/'), "s_suppkey", F.lit("/"), y, F.lit('">DESCARGAR</a>')))
    action = action.otherwise(F.lit('<a href="/ayuda">Ayuda</a>'))
    block = F.concat(
        F.lit('<div class="pkg-container x"><div class="package-info"><p>Actualizado: '),
        y,
        F.lit('-01-01</p><p>otro 1990-01-01</p></div><div class="pkg-actions"><a href="/ver">Ver</a>'),
        action,
        F.lit("</div></div>"),
    )
    blocks = suppliers.groupBy(F.col("s_suppkey").alias("page_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", block.alias("b")))), lambda s: s["b"]), "\n").alias("body")
    )
    portal = blocks.select(
        "page_id", F.concat(F.lit('<html><body><a href="/otro.zip">Otro</a>'), "body", F.lit("</body></html>")).alias("html")
    )
    given = table(spark, sf, "pages").select((-F.col("page_id") - 1).alias("page_id"), "html")
    return pages.package_links(portal.unionByName(given))


# --- query surface ------------------------------------------------------------------------


def _lake(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    names = ("dim_comercios", "dim_sucursales", "dim_productos")
    return {"precios": _precios(spark, sf)} | {n: bind(spark, sf, n) for n in names}


@registered
def guarded_query(spark, sf):
    sql = """
        SELECT p.fecha_vigencia, c.razon_social, COUNT(*) AS filas, MAX(p.precio_lista) AS maximo
        FROM lake.precios p JOIN lake.dim_comercios c
          ON p.id_comercio = c.id_comercio AND p.id_bandera = c.id_bandera AND p.fecha_vigencia = c.fecha_vigencia
        GROUP BY p.fecha_vigencia, c.razon_social -- per merchant"""
    return query.guarded_query(spark, sql, _lake(spark, sf))


@registered
def preview_table(spark, sf):
    """The preview of a table smaller than the row limit is the table."""
    summary = prices_by_banner(spark, sf).select("bandera_nombre", "precios")
    return query.preview_table(spark, "lake.banners", {"banners": summary})
