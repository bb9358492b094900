"""Ad hoc reports over the fact and the current dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions import price_decimal
from gondola.functions.measures import TIMES
from gondola.schema import MERCHANT_KEYS

# Prices outside this range are suspicious; report sizes.
OUTLIER_ABOVE, OUTLIER_BELOW = 1_000_000, 1
OUTLIER_ROWS, COVERAGE_ROWS = 50, 20


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def prices_by_banner(precios: DataFrame, comercios: DataFrame) -> DataFrame:
    """Price rows per banner name, most first; counted per id before the names are joined."""
    counts = precios.groupBy(*MERCHANT_KEYS).agg(F.count("*").alias("_n"))
    return (
        counts.join(comercios.select(*MERCHANT_KEYS, "bandera_nombre"), list(MERCHANT_KEYS))
        .groupBy("bandera_nombre")
        .agg(F.sum("_n").alias("precios"))
        .orderBy(F.col("precios").desc(), "bandera_nombre")
    )


def price_outliers(
    precios: DataFrame,
    productos: DataFrame,
    comercios: DataFrame,
    above: float = OUTLIER_ABOVE,
    below: float = OUTLIER_BELOW,
    rows: int = OUTLIER_ROWS,
) -> DataFrame:
    price = F.col("precio_lista")
    return (
        precios.filter((price > above) | (price < below))
        .select(*MERCHANT_KEYS, "id_producto", "precio_lista")
        .join(productos.select("id_producto", "descripcion", "marca"), "id_producto")
        .join(comercios.select(*MERCHANT_KEYS, "bandera_nombre"), list(MERCHANT_KEYS))
        .select("descripcion", "marca", "precio_lista", "bandera_nombre")
        .orderBy(
            price.desc(),
            F.col("descripcion").asc_nulls_last(),
            F.col("marca").asc_nulls_last(),
            F.col("bandera_nombre").asc_nulls_last(),
        )
        .limit(rows)
    )


def product_chain_coverage(
    precios: DataFrame, productos: DataFrame, comercios: DataFrame, rows: int = COVERAGE_ROWS
) -> DataFrame:
    """Descriptions sold under the most banners; (product, banner) pairs are made distinct first."""
    return (
        precios.select("id_producto", *MERCHANT_KEYS)
        .distinct()
        .join(productos.select("id_producto", "descripcion"), "id_producto")
        .join(comercios.select(*MERCHANT_KEYS, "bandera_nombre"), list(MERCHANT_KEYS))
        .groupBy("descripcion")
        .agg(F.count_distinct("bandera_nombre").alias("cadenas"))
        .orderBy(F.col("cadenas").desc(), F.col("descripcion").asc_nulls_last())
        .limit(rows)
    )


def latest_scrape(precios: DataFrame) -> DataFrame:
    return precios.agg(F.max("scraped_at").alias("latest_scrape_date"))


def basket_cost(prices: DataFrame, baskets: DataFrame) -> DataFrame:
    """Cost of each basket in each store that has all its products, and the saving there.

    ``prices``: one price per store and product. ``baskets``: basket_id, id_producto,
    cantidad. Savings are against the dearest complete store, null when no other
    store can be compared.
    """
    wanted = baskets.groupBy("basket_id").agg(F.count("*").alias("_items"))
    store = ["id_comercio", "id_bandera", "id_sucursal"]
    price, times = F.col("precio_lista"), F.col("cantidad")
    exact = price_decimal(price)
    totals = (
        prices.select(*store, "id_producto", "precio_lista")
        .join(baskets.select("basket_id", "id_producto", "cantidad"), "id_producto")
        .groupBy("basket_id", *store)
        .agg(
            F.when(F.count(exact) == F.count(price), F.sum(exact * times.cast(TIMES))).alias("_exact"),
            F.sum(price * times).alias("_plain"),
            F.count("*").alias("productos"),
        )
        .join(wanted, "basket_id")
        .filter(F.col("productos") == F.col("_items"))
    )
    dearest = totals.groupBy("basket_id").agg(
        F.when(F.count("_exact") == F.count("*"), F.max("_exact")).alias("_dearest"),
        F.max(F.coalesce(F.col("_exact").cast("double"), "_plain")).alias("_dearest_plain"),
        F.count("*").alias("_stores"),
    )
    total = F.coalesce(F.col("_exact").cast("double"), "_plain")
    saving = F.coalesce((F.col("_dearest") - F.col("_exact")).cast("double"), F.col("_dearest_plain") - total)
    return totals.join(dearest, "basket_id").select(
        "basket_id", *store, "productos", total.alias("total"), F.when(F.col("_stores") > 1, saving).alias("ahorro")
    )
