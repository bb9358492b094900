"""The price fact: staging, deduplicated quotes, latest prices, price comparison."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions import exact_sum
from gondola.operators.latest import latest_per_key
from gondola.operators.silver import project
from gondola.schema import DATE, MERCHANT_KEYS, QUOTE_KEYS, STORE_KEYS

# Fixed value: first business date read by a full build.
START_DATE = "2025-01-01"

QUOTE_COLUMNS = (
    DATE,
    "id_comercio",
    "id_bandera",
    "id_sucursal",
    "id_producto",
    "descripcion",
    "marca",
    "precio_lista",
    "precio_promo1",
    "leyenda_promo1",
    "precio_promo2",
    "leyenda_promo2",
    "scraped_at",
)


def stage_precios(silver: DataFrame, start: str | date | None = None) -> DataFrame:
    """Silver fact with contract types; ``start`` prunes date partitions."""
    staged = project(silver, "precios")
    return staged if start is None else staged.filter(F.col(DATE) >= F.lit(str(start)).cast("date"))


def date_window(df: DataFrame, as_of: date, days_back: int = 5) -> DataFrame:
    """Rows of the last ``days_back`` days; a literal bound, so date partitions prune."""
    return df.filter(F.col(DATE) >= F.lit((as_of - timedelta(days=days_back)).isoformat()).cast("date"))


def price_quotes(staged: DataFrame, keys: Sequence[str] = QUOTE_KEYS) -> DataFrame:
    """One row per key: the last scraped price of the day."""
    return latest_per_key(staged.select(*QUOTE_COLUMNS), keys, ["scraped_at"])


def latest_prices(
    precios: DataFrame,
    sucursales: DataFrame,
    comercios: DataFrame,
    columns: Sequence[str] | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Last scraped price per store and product with store and banner names.

    The join keys are part of the dedup key and the dimensions hold one row per key,
    so deduplicating first gives the same rows and joins far fewer of them. ``columns`` are the
    fact columns wanted (all by default); ``products`` (id_producto, distinct) restricts the fact
    before the dedup. Ties of the scrape time go by the columns of the whole fact.
    """
    rows = precios if products is None else precios.join(products, "id_producto", "left_semi")
    last = latest_per_key(rows, [*STORE_KEYS, "id_producto"], ["scraped_at"])
    if columns is not None:
        last = last.select(*columns)
    stores = sucursales.select(*STORE_KEYS, "nombre", "localidad", "provincia")
    banners = comercios.select(*MERCHANT_KEYS, "bandera_nombre")
    return last.join(stores, list(STORE_KEYS)).join(banners, list(MERCHANT_KEYS))


def price_comparison(
    precios: DataFrame,
    productos: DataFrame,
    sucursales: DataFrame,
    comercios: DataFrame,
    as_of: date,
    days_back: int = 7,
) -> DataFrame:
    """Each recent price next to the average, lowest and highest of its product and date.

    The fact is summed to distinct rows once; both the rows and the measures read that exchange. The measures are
    an aggregate joined back, not a window: partial sums merge before the shuffle, and the join can
    broadcast the small side or split a product that holds much of the day, where a window would
    need it in one task. Dimensions are joined once, with names; the measures need only their keys.
    """
    since = F.lit((as_of - timedelta(days=days_back)).isoformat()).cast("timestamp_ntz")
    price, times = F.col("precio_lista"), F.col("_n")
    known = (
        precios.filter(F.col("scraped_at") >= since)
        .groupBy("id_producto", DATE, *STORE_KEYS, "precio_lista")
        .agg(F.count("*").alias("_n"))
        .join(sucursales.select(*STORE_KEYS, "nombre", "localidad"), list(STORE_KEYS))
        .join(comercios.select(*MERCHANT_KEYS, "bandera_nombre"), list(MERCHANT_KEYS))
    )
    spread = known.groupBy("id_producto", DATE).agg(
        (exact_sum(price, times) / F.sum(F.when(price.isNotNull(), times))).alias("precio_promedio"),
        F.min(price).alias("precio_minimo"),
        F.max(price).alias("precio_maximo"),
    )
    named = spread.join(productos.select("id_producto", "descripcion", "marca"), "id_producto")
    return (
        known.join(named, ["id_producto", DATE])
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))  # equal rows stay as many
        .select(
            "id_producto",
            "descripcion",
            "marca",
            "id_comercio",
            "bandera_nombre",
            "id_sucursal",
            "nombre",
            "localidad",
            "precio_lista",
            DATE,
            "precio_promedio",
            "precio_minimo",
            "precio_maximo",
        )
    )
