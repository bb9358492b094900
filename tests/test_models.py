from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gondola.operators import adhoc, dims, facts, marts, quality
from gondola.operators.silver import project
from gondola.schema import SILVER, STORE_KEYS

D1, D2 = date(2026, 1, 1), date(2026, 1, 2)


@pytest.fixture
def prices(spark):
    """Silver price rows from (comercio, bandera, sucursal, producto, price, promo, hour, day)."""

    def make(*rows):
        data = [
            (c, b, s, p, price, promo, datetime(2026, 1, 3, hour), day, f"DISC: LECHE {p}", "M")
            for c, b, s, p, price, promo, hour, day in rows
        ]
        df = spark.createDataFrame(
            data,
            "id_comercio string, id_bandera string, id_sucursal string, id_producto string, precio_lista double, "
            "precio_promo1 double, scraped_at timestamp_ntz, fecha_vigencia date, descripcion string, marca string",
        )
        return project(df, "precios")

    return make


def rows_as(spark, table, *rows):
    names = list(rows[0])
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema=[SILVER[table][n] and n for n in names])
    return project(df, table)


@pytest.fixture
def stores(spark):
    base = {"id_bandera": "1", "nombre": "N", "localidad": "L"}
    return rows_as(
        spark,
        "dim_sucursales",
        base | {"id_comercio": "1", "id_sucursal": "10", "provincia": "AR-S", "fecha_vigencia": D1},
        base | {"id_comercio": "1", "id_sucursal": "10", "provincia": "AR-B", "fecha_vigencia": D2},
        base | {"id_comercio": "1", "id_sucursal": "11", "provincia": "AR-B", "fecha_vigencia": D1},
        base | {"id_comercio": "2", "id_sucursal": "10", "provincia": None, "fecha_vigencia": D1},
    )


@pytest.fixture
def merchants(spark):
    return rows_as(
        spark,
        "dim_comercios",
        {"id_comercio": "1", "id_bandera": "1", "bandera_nombre": "Uno", "fecha_vigencia": D1},
        {"id_comercio": "2", "id_bandera": "1", "bandera_nombre": "Dos", "fecha_vigencia": D1},
    )


@pytest.fixture
def products(spark):
    return rows_as(
        spark,
        "dim_productos",
        {"id_producto": "p", "descripcion": "viejo", "marca": "M", "fecha_vigencia": D1},
        {"id_producto": "p", "descripcion": "HVDC LECHE", "marca": "M", "fecha_vigencia": D2},
    )


def test_current_dimension_is_the_newest_snapshot(stores):
    rows = {(r.id_comercio, r.id_sucursal): r.provincia for r in dims.sucursales_current(stores).collect()}
    assert rows == {("1", "10"): "AR-B", ("1", "11"): "AR-B", ("2", "10"): None}


def test_last_scrape_wins_and_ties_are_stable(prices):
    rows = prices(
        ("1", "1", "10", "p", 20.0, None, 1, D1),
        ("1", "1", "10", "p", 30.0, None, 2, D1),
        ("1", "1", "10", "p", 25.0, None, 2, D1),
        ("1", "1", "10", "p", 40.0, None, 1, D2),
    )
    for parts in (1, 6):
        quotes = facts.price_quotes(rows.repartition(parts))
        assert {(r.fecha_vigencia, r.precio_lista) for r in quotes.collect()} == {(D1, 25.0), (D2, 40.0)}
    quality.assert_grain(facts.price_quotes(rows), quality.GRAIN["fct_price_quotes"], "quotes")
    with pytest.raises(ValueError, match="repeats"):
        quality.assert_grain(rows, quality.GRAIN["fct_price_quotes"], "staged")


def test_start_date_and_window(prices):
    rows = prices(("1", "1", "10", "p", 20.0, None, 1, D1), ("1", "1", "10", "p", 40.0, None, 1, D2))
    assert facts.stage_precios(rows, D2).count() == 1
    assert facts.stage_precios(rows).count() == 2
    assert facts.date_window(rows, date(2026, 1, 7), days_back=5).count() == 1


def test_series(prices, stores):
    rows = prices(
        ("1", "1", "10", "p", 20.0, None, 1, D1),
        ("1", "1", "11", "p", 40.0, None, 1, D1),
        ("2", "1", "10", "p", 99.0, None, 1, D1),
        ("1", "1", "11", "q", 9.99, None, 1, D1),
    )
    out = marts.price_timeseries(facts.price_quotes(rows), dims.sucursales_current(stores)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.provincia, r.precio_promedio, r.precio_mediana, r.num_sucursales) == ("AR-B", 30.0, 30.0, 2)
    assert (r.descripcion_clean, r.categoria_inferida) == ("LECHE p", "Lacteos")
    assert r.precio_desvio == pytest.approx(200**0.5)


def test_summary_keeps_products_without_a_row_and_null_promotions(prices, products):
    rows = prices(
        ("1", "1", "10", "p", 20.0, 15.0, 1, D1),
        ("1", "1", "11", "p", 10.0, None, 1, D1),
        ("1", "1", "11", "p", 0.0, 1.0, 1, D1),
        ("1", "1", "10", "q", 5.0, None, 1, D1),
    )
    out = {r.id_producto: r for r in marts.daily_price_summary(rows, dims.productos_current(products)).collect()}
    p, q = out["p"], out["q"]
    assert (p.num_observaciones, p.precio_promedio, p.mejor_precio_promo) == (2, 15.0, 15.0)
    assert (p.descripcion, q.descripcion, q.mejor_precio_promo) == ("HVDC LECHE", None, None)


def test_coverage_keeps_stores_without_province(prices, stores):
    rows = prices(
        ("1", "1", "10", "p", 20.0, None, 1, D1),
        ("1", "1", "11", "p", 20.0, None, 1, D1),
        ("2", "1", "10", "p", 20.0, None, 1, D1),
        ("9", "1", "90", "q", 20.0, None, 1, D1),
    )
    out = {r.provincia: tuple(r)[2:] for r in marts.store_coverage(rows, dims.sucursales_current(stores)).collect()}
    assert out == {"AR-B": (2, 1, 1, 2), None: (2, 2, 2, 2)}


def test_pairs_need_three_observations_each(prices, merchants, products):
    rows = [("1", "1", str(i), "p", 10.0, None, 1, D1) for i in range(3)]
    rows += [("2", "1", str(i), "p", 20.0, None, 1, D1) for i in range(3)]
    two = [("2", "1", str(i), "q", 20.0, None, 1, D1) for i in range(2)]
    args = dims.productos_current(products), merchants
    out = marts.cross_price_pairs(prices(*rows, *two), *args).collect()
    assert [(r.cadena_a, r.cadena_b, r.diferencia_pct, r.num_obs_a) for r in out] == [("Dos", "Uno", -50.0, 3)]
    assert (out[0].descripcion_clean, out[0].categoria_inferida) == ("LECHE", "Lacteos")
    assert marts.chain_avg_prices(prices(*rows, *two), *args).count() == 2


def test_hypothesis_rows(prices, stores, merchants, products):
    rows = prices(
        ("1", "1", "10", "p", 20.0, 15.0, 1, D1),
        ("1", "1", "11", "q", 20.0, None, 1, D1),
        ("2", "1", "10", "p", 20.0, None, 1, D1),
        ("1", "1", "10", "p", 9.0, None, 1, D1),
    )
    out = marts.price_hypothesis(
        rows, dims.productos_current(products), dims.sucursales_current(stores), dims.comercios_current(merchants)
    )
    got = {(r.id_producto, r.tiene_promo, r.precio_efectivo, r.categoria_inferida, r.bandera_nombre) for r in out.collect()}
    assert got == {("p", True, 15.0, "Lacteos", "Uno"), ("q", False, 20.0, "Otros", "Uno")}


def test_latest_and_comparison(prices, stores, merchants, products):
    rows = prices(
        ("1", "1", "10", "p", 20.0, None, 1, D1),
        ("1", "1", "10", "p", 30.0, None, 2, D2),
        ("1", "1", "11", "p", 50.0, None, 2, D2),
        ("7", "1", "11", "p", 70.0, None, 2, D2),
    )
    by_banner = dims.sucursales_current(stores, STORE_KEYS)
    latest = facts.latest_prices(rows, by_banner, merchants)
    assert {(r.id_sucursal, r.precio_lista, r.bandera_nombre) for r in latest.collect()} == {
        ("10", 30.0, "Uno"),
        ("11", 50.0, "Uno"),
    }
    args = dims.productos_current(products), by_banner, merchants
    seen = facts.price_comparison(rows, *args, as_of=date(2026, 1, 9)).collect()
    assert {(r.precio_lista, r.precio_promedio, r.precio_maximo) for r in seen} == {
        (20.0, 20.0, 20.0),
        (30.0, 40.0, 50.0),
        (50.0, 40.0, 50.0),
    }
    assert facts.price_comparison(rows, *args, as_of=date(2026, 2, 9)).isEmpty()


def test_reports(prices, merchants, products):
    rows = prices(
        ("1", "1", "10", "p", 0.5, None, 1, D1),
        ("2", "1", "10", "p", 2e6, None, 1, D1),
        ("2", "1", "11", "p", 20.0, None, 1, D1),
    )
    current = dims.productos_current(products)
    assert [tuple(r) for r in adhoc.prices_by_banner(rows, merchants).collect()] == [("Dos", 2), ("Uno", 1)]
    assert [r.precio_lista for r in adhoc.price_outliers(rows, current, merchants).collect()] == [2e6, 0.5]
    assert [tuple(r) for r in adhoc.product_chain_coverage(rows, current, merchants).collect()] == [("HVDC LECHE", 2)]
    assert adhoc.latest_scrape(rows).head()[0] == datetime(2026, 1, 3, 1)
    assert {tuple(r) for r in adhoc.table_counts({"a": rows, "b": merchants}).collect()} == {("a", 3), ("b", 2)}


def test_basket(spark, prices):
    rows = prices(
        ("1", "1", "10", "p", 10.1, None, 1, D1),
        ("1", "1", "10", "q", 1.0, None, 1, D1),
        ("1", "1", "11", "p", 12.0, None, 1, D1),
        ("1", "1", "11", "q", 2.0, None, 1, D1),
        ("1", "1", "12", "p", 1.0, None, 1, D1),
    )
    baskets = spark.createDataFrame([("b", "p", 3), ("b", "q", 1), ("solo", "q", 1)], "basket_id string, id_producto string, cantidad int")
    out = {(r.basket_id, r.id_sucursal): (r.total, r.ahorro) for r in adhoc.basket_cost(rows, baskets).collect()}
    assert out[("b", "10")] == (31.3, 6.7)
    assert out[("b", "11")] == (38.0, 0.0)
    assert ("b", "12") not in out
    one = adhoc.basket_cost(rows.filter(F.col("id_sucursal") == "10"), baskets.filter("basket_id = 'b'"))
    assert [(r.total, r.ahorro) for r in one.collect()] == [(31.3, None)]


def test_health_and_schema(spark, prices, stores):
    rows = prices(("1", "1", "10", "p", 5.0, None, 1, D1))
    bad_store = stores.withColumn("provincia", F.coalesce("provincia", F.lit("Chaco")))
    report = {
        (r.tabla, r.control, r.fecha_vigencia): (r.severidad, r.valor, r.aprobado)
        for r in quality.silver_health({"precios": rows, "dim_sucursales": bad_store}).collect()
    }
    assert report[("precios", "bajo_minimo", D1)] == ("warn", 1, False)
    assert report[("precios", "nulos_marca", D1)] == ("error", 0, True)
    assert report[("dim_sucursales", "provincia_invalida", D1)] == ("error", 1, False)
    assert report[("dim_sucursales", "provincia_invalida", D2)] == ("error", 0, True)
    assert quality.schema_differences(rows, "precios") == []
    odd = rows.drop("marca").withColumn("x", F.lit(1)).withColumn("ean", F.lit("1"))
    assert {(s, c) for s, c, _ in quality.schema_differences(odd, "precios")} == {
        ("error", "marca"),
        ("error", "ean"),
        ("warn", "x"),
    }
    assert len(quality.sample_rows(rows).columns) == 8


def test_hot_key_is_cut_before_the_shuffle(prices):
    plan = facts.price_quotes(prices(("1", "1", "10", "p", 1.0, None, 1, D1)))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2
