"""Daily marts and gold datasets.

The reference dimensions hold one row per key (see ``dims``), so descriptions and
names are functions of the ids: aggregates run on ids first and the dimension is
joined to the much smaller result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions import (
    OTHER_CATEGORY,
    categorize_product,
    clean_description,
    exact_avg,
    exact_sum,
    percent_change,
)
from gondola.schema import DATE, MERCHANT_KEYS, STORE_CURRENT_KEYS

# Lowest price the gold datasets accept, observations a chain average needs.
GOLD_MIN_PRICE = 10.0
MIN_CHAIN_OBSERVATIONS = 3


def daily_price_summary(precios: DataFrame, productos: DataFrame) -> DataFrame:
    """Per date and product: observations, average, lowest, highest, best promotion (null if none)."""
    prices = (
        precios.filter(F.col("precio_lista") > 0)
        .groupBy(DATE, "id_producto")
        .agg(
            F.count("*").alias("num_observaciones"),
            exact_avg(F.col("precio_lista")).alias("precio_promedio"),
            F.min("precio_lista").alias("precio_minimo"),
            F.max("precio_lista").alias("precio_maximo"),
            F.min("precio_promo1").alias("mejor_precio_promo"),
        )
    )
    names = productos.select("id_producto", "descripcion", "marca")
    return prices.join(names, "id_producto", "left").select(
        DATE,
        "id_producto",
        "descripcion",
        "marca",
        "num_observaciones",
        "precio_promedio",
        "precio_minimo",
        "precio_maximo",
        "mejor_precio_promo",
    )


def store_coverage(precios: DataFrame, sucursales: DataFrame) -> DataFrame:
    """Per date and province (null kept): stores, chains and products that report, and prices.

    One pass: every price row brings its store, chain and product as a kind and a value, which partial
    aggregates reduce to the distinct ones before the first shuffle. A second one counts them by kind. A province
    with most rows is spread over its values; no buffer holds a group.
    """
    place = [DATE, "provincia"]
    placed = precios.select(DATE, "id_comercio", "id_sucursal", "id_producto").join(
        sucursales.select(*STORE_CURRENT_KEYS, "provincia"), list(STORE_CURRENT_KEYS), "left"
    )
    kinds = {"sucursales_activas": "id_sucursal", "cadenas_activas": "id_comercio", "productos_reportados": "id_producto"}
    values = F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*map(F.col, kinds.values())))
    found = (
        placed.select(*place, F.explode(values).alias("_kind", "_value"))
        .groupBy(*place, "_kind", "_value")
        .agg(F.count("_value").alias("_n"))
    )
    total = F.sum(F.when(F.col("_kind") == "productos_reportados", F.col("_n")).otherwise(0))
    return found.groupBy(*place).agg(
        *(F.count(F.when(F.col("_kind") == kind, F.col("_value"))).alias(kind) for kind in kinds),
        total.alias("total_precios"),
    )


def price_timeseries(quotes: DataFrame, sucursales: DataFrame, approx_median: bool = False) -> DataFrame:
    """Price series per date, product and province from the deduplicated quotes.

    One scan of the quotes: they are summed to one row per series and price, with how often the price occurs
    and the stores that have it, and that to the series. Its buffer holds each distinct price once; median, mean
    and deviation are read off it in order of price, so no result depends on partitioning. An
    approximate median has a sketch of bounded size per series instead, and the deviation of partial moments.
    """
    key = [DATE, "id_producto", "provincia"]
    price, times = F.col("precio_lista"), F.col("_n")
    stores = sucursales.select(*STORE_CURRENT_KEYS, "provincia").filter(F.col("provincia").isNotNull())
    placed = quotes.filter(price >= GOLD_MIN_PRICE).join(stores, list(STORE_CURRENT_KEYS))
    names = [F.min("descripcion_clean").alias("descripcion_clean"), F.min("marca").alias("marca")]
    placed = placed.withColumn("descripcion_clean", clean_description(F.col("descripcion")))
    extremes = [F.min(price).alias("precio_min"), F.max(price).alias("precio_max")]
    if approx_median:
        series = placed.groupBy(*key).agg(
            *names,
            *extremes,
            exact_avg(price).alias("precio_promedio"),
            F.percentile_approx(price, 0.5).alias("precio_mediana"),
            F.stddev_samp(price).alias("precio_desvio"),
            F.count("*").alias("num_observaciones"),
            F.size(F.collect_set("id_sucursal")).cast("long").alias("num_sucursales"),
        )
    else:
        per_price = placed.groupBy(*key, "precio_lista").agg(
            *names, F.count("*").alias("_n"), F.collect_set("id_sucursal").alias("_stores")
        )
        series = per_price.groupBy(*key).agg(
            *names,
            *extremes,
            exact_sum(price, times).alias("_sum"),
            F.percentile(price, 0.5, times).alias("precio_mediana"),
            F.sum(times).alias("num_observaciones"),
            F.collect_list(F.struct(price.alias("price"), times.alias("times"))).alias("_prices"),
            F.collect_set("_stores").alias("_stores"),
        )
        n, mean = F.col("num_observaciones"), F.col("_sum") / F.col("num_observaciones")
        # Squares of differences from the mean, not of prices: nothing cancels.
        squares = F.aggregate(
            F.array_sort("_prices"),
            F.lit(0.0),
            lambda total, x: total + x["times"] * F.pow(x["price"] - F.col("precio_promedio"), 2),
        )
        series = series.withColumn("precio_promedio", mean).withColumns(
            {
                "precio_desvio": F.when(n > 1, F.sqrt(squares / (n - 1))),
                "num_sucursales": F.size(F.array_distinct(F.flatten("_stores"))).cast("long"),
            }
        )
    return series.select(
        DATE,
        "id_producto",
        "descripcion_clean",
        "marca",
        categorize_product(F.col("descripcion_clean")).alias("categoria_inferida"),
        "provincia",
        "precio_promedio",
        "precio_mediana",
        "precio_min",
        "precio_max",
        "precio_desvio",
        "num_observaciones",
        "num_sucursales",
    )


def _chain_prices(precios: DataFrame, comercios: DataFrame) -> DataFrame:
    """Average price per date, product and chain name with at least three observations.

    The merchant table is a few rows per company, so it is joined before the sums: one
    partial aggregate and one shuffle of products x chains per day.
    """
    chains = comercios.select(*MERCHANT_KEYS, F.col("bandera_nombre").alias("cadena")).filter(
        F.col("cadena").isNotNull()
    )
    return (
        precios.filter(F.col("precio_lista") >= GOLD_MIN_PRICE)
        .select(DATE, "id_producto", *MERCHANT_KEYS, "precio_lista")
        .join(chains, list(MERCHANT_KEYS))
        .groupBy(DATE, "id_producto", "cadena")
        .agg(
            exact_avg(F.col("precio_lista")).alias("precio_promedio"),
            F.count("*").alias("num_observaciones"),
        )
        .filter(F.col("num_observaciones") >= MIN_CHAIN_OBSERVATIONS)
    )


def _product_names(productos: DataFrame) -> DataFrame:
    """Cleaned description, brand and category, worked out once per product."""
    description = clean_description(F.col("descripcion"))
    return productos.select(
        "id_producto",
        description.alias("descripcion_clean"),
        "marca",
        categorize_product(description).alias("categoria_inferida"),
    )


def _category() -> Column:
    """Category after a left join: no product row means no description that could match a rule."""
    return F.coalesce("categoria_inferida", F.lit(OTHER_CATEGORY)).alias("categoria_inferida")


def chain_avg_prices(precios: DataFrame, productos: DataFrame, comercios: DataFrame) -> DataFrame:
    """Average price per date, product and chain, with the product's description and brand."""
    names = _product_names(productos).drop("categoria_inferida")
    return (
        _chain_prices(precios, comercios)
        .join(names, "id_producto", "left")
        .select(
            DATE,
            "id_producto",
            "descripcion_clean",
            "marca",
            "cadena",
            "precio_promedio",
            "num_observaciones",
        )
    )


def cross_price_pairs(precios: DataFrame, productos: DataFrame, comercios: DataFrame) -> DataFrame:
    """Chain pairs (a < b) with a price for the same product and date.

    Both sides are the same aggregate with the same columns, so Spark shuffles it once
    and reads the exchange twice; product names are joined to the pairs. A product has
    at most one row per chain and date, and the pairs are the dataset itself.
    """
    side = _chain_prices(precios, comercios)

    def named(suffix: str) -> DataFrame:
        return side.select(
            F.col(DATE).alias(f"_date_{suffix}"),
            F.col("id_producto").alias(f"_product_{suffix}"),
            F.col("cadena").alias(f"cadena_{suffix}"),
            F.col("precio_promedio").alias(f"precio_promedio_{suffix}"),
            F.col("num_observaciones").alias(f"num_obs_{suffix}"),
        )

    pairs = named("a").join(
        named("b"),
        (F.col("_date_a") == F.col("_date_b"))
        & (F.col("_product_a") == F.col("_product_b"))
        & (F.col("cadena_a") < F.col("cadena_b")),
    )
    pairs = pairs.withColumnsRenamed({"_date_a": DATE, "_product_a": "id_producto"})
    price_a, price_b = F.col("precio_promedio_a"), F.col("precio_promedio_b")
    return pairs.join(_product_names(productos), "id_producto", "left").select(
        DATE,
        "id_producto",
        "descripcion_clean",
        "marca",
        _category(),
        "cadena_a",
        "cadena_b",
        price_a,
        price_b,
        F.ln(price_a).alias("ln_precio_a"),
        F.ln(price_b).alias("ln_precio_b"),
        "num_obs_a",
        "num_obs_b",
        percent_change(price_a, price_b).alias("diferencia_pct"),
    )


def price_hypothesis(
    precios: DataFrame, productos: DataFrame, sucursales: DataFrame, comercios: DataFrame
) -> DataFrame:
    """One flat row per store price with product, chain and place."""
    stores = sucursales.select(*STORE_CURRENT_KEYS, "provincia", "localidad").filter(
        F.col("provincia").isNotNull()
    )
    banners = comercios.select(*MERCHANT_KEYS, "bandera_nombre")
    return (
        precios.filter(F.col("precio_lista") >= GOLD_MIN_PRICE)
        .select(DATE, "id_producto", "id_sucursal", *MERCHANT_KEYS, "precio_lista", "precio_promo1")
        .join(stores, list(STORE_CURRENT_KEYS))
        .join(_product_names(productos), "id_producto", "left")
        .join(banners, list(MERCHANT_KEYS), "left")
        .select(
            DATE,
            "id_producto",
            "id_comercio",
            "id_sucursal",
            "descripcion_clean",
            "marca",
            _category(),
            "bandera_nombre",
            "provincia",
            "localidad",
            "precio_lista",
            F.col("precio_promo1").isNotNull().alias("tiene_promo"),
            F.coalesce("precio_promo1", "precio_lista").alias("precio_efectivo"),
        )
    )
