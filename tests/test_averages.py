"""Averages of odd prices, one scan a report, and exact results whatever the partitioning."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from gondola.operators import adhoc, facts, marts

DAY = date(2026, 1, 15)
ODD = {"nan": float("nan"), "huge": 1e14, "infinite": float("inf"), "small": 1e-13 + 20.0}


def sales(spark, *prices, product="1"):
    rows = [(DAY, "1", "1", str(i), product, p, None, "Pan", "A") for i, p in enumerate(prices)]
    schema = (
        "fecha_vigencia date, id_comercio string, id_bandera string, id_sucursal string, id_producto string, precio_lista double, "
        "precio_promo1 double, descripcion string, marca string"
    )
    return spark.createDataFrame(rows, schema).withColumn("scraped_at", F.lit("2026-01-15 10:00:00").cast("timestamp_ntz"))


def places(spark, n=50):
    rows = [(DAY, "1", "1", str(i), "S", "AR-S", "Rosario") for i in range(n)]
    return spark.createDataFrame(
        rows, "fecha_vigencia date, id_comercio string, id_bandera string, id_sucursal string, nombre string, provincia string, localidad string"
    )


def banners(spark):
    return spark.createDataFrame([("1", "1", "Uno")], "id_comercio string, id_bandera string, bandera_nombre string")


def products(spark):
    return spark.createDataFrame([("1", "Pan", "A")], "id_producto string, descripcion string, marca string")


def same(a, b):
    return a == pytest.approx(b, rel=1e-12, nan_ok=True)


@pytest.mark.parametrize("odd", ODD)
@pytest.mark.parametrize("report", ["series", "approximate", "comparison", "basket", "summary"])
def test_odd_prices_count_in_the_sum_as_in_the_count(spark, odd, report):
    value = ODD[odd]
    rows = sales(spark, 20.0, value, 20.0)
    mean = (40.0 + value) / 3
    if report in ("series", "approximate"):
        r = marts.price_timeseries(rows, places(spark), approx_median=report == "approximate").first()
        assert same(r.precio_promedio, mean) and (r.num_observaciones, r.num_sucursales) == (3, 3)
    elif report == "comparison":
        found = facts.price_comparison(rows, products(spark), places(spark), banners(spark), date(2026, 1, 16)).collect()
        assert len(found) == 3 and all(same(r.precio_promedio, mean) for r in found)
    elif report == "summary":
        assert same(marts.daily_price_summary(rows, products(spark)).first().precio_promedio, mean)
    else:
        prices = sales(spark, 20.0, 5.0).unionByName(sales(spark, value, 1.0, product="2"))
        baskets = spark.createDataFrame([("b", "1", 2), ("b", "2", 3)], "basket_id string, id_producto string, cantidad int")
        found = {r.id_sucursal: r for r in adhoc.basket_cost(prices, baskets).collect()}
        assert same(found["0"].total, 40.0 + 3 * value) and found["1"].total == 13.0
        assert same(found["1"].ahorro, 40.0 + 3 * value - 13.0)


def test_series_equal_plain_statistics(spark):
    import statistics

    prices = [10.0, 10.1, 10.1, 10.1, 12.5, 99.99, 10.0, 1e6 + 0.01]
    r = marts.price_timeseries(sales(spark, *prices), places(spark)).first()
    assert same(r.precio_desvio, statistics.stdev(prices)) and r.precio_mediana == statistics.median(prices)
    assert (r.num_observaciones, r.num_sucursales) == (8, 8)
    assert marts.price_timeseries(sales(spark, 50.0), places(spark)).first().precio_desvio is None
    assert marts.price_timeseries(sales(spark, 50.0, 50.0), places(spark)).first().precio_desvio == 0.0
    found = {tuple(marts.price_timeseries(sales(spark, *prices).repartition(n), places(spark)).first()) for n in (1, 3, 7)}
    assert len(found) == 1


def test_coverage_counts_distinct_values_and_keeps_null_provinces(spark):
    rows = sales(spark, 20.0, 30.0, 40.0).unionByName(sales(spark, 20.0, 20.0, product="2")).unionByName(sales(spark, 5.0, product=None))
    far = rows.withColumn("id_sucursal", F.concat(F.lit("x"), "id_sucursal"))
    found = {r.provincia: tuple(r)[2:] for r in marts.store_coverage(rows.unionByName(far), places(spark)).collect()}
    assert found == {"AR-S": (3, 1, 2, 5), None: (3, 1, 2, 5)}


@pytest.fixture
def no_broadcast(spark, tmp_path):
    """The reports' inputs as written tables, with broadcasts off."""
    sales(spark, *[10.0 + i % 7 for i in range(40)]).write.parquet(str(tmp_path / "fact"))
    for name, df in (("stores", places(spark)), ("banners", banners(spark)), ("products", products(spark))):
        df.write.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield lambda name: spark.read.parquet(str(tmp_path / name))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "report, exchanges",
    [("series", 4), ("coverage", 4), ("comparison", 13)],
)
def test_reports_read_the_fact_once(spark, no_broadcast, report, exchanges):
    fact, stores = no_broadcast("fact"), no_broadcast("stores")
    df = {
        "series": lambda: marts.price_timeseries(fact, stores),
        "coverage": lambda: marts.store_coverage(fact, stores),
        "comparison": lambda: facts.price_comparison(fact, no_broadcast("products"), stores, no_broadcast("banners"), date(2026, 1, 16)),
    }[report]()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = plan.count("FileScan")
    found = (plan.count("Exchange hashpartitioning") <= exchanges, plan.count("ReusedExchange") > 0, scans, plan.count("/fact]"))
    assert found == {"series": (True, False, 2, 1), "coverage": (True, False, 2, 1), "comparison": (True, True, 6, 1)}[report], plan
