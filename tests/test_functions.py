from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gondola import functions as G


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).head()[0]


@pytest.mark.parametrize(
    "text, number",
    [("1.0", 1), ("1.7", 1), ("-3", -3), ("x", None), ("NaN", None), ("99999999999", None), (None, None), ("1d", None)],
)
def test_soft_int(spark, text, number):
    assert one(spark, text, G.soft_int) == number


def test_soft_double_and_long(spark):
    assert one(spark, "100.5", G.soft_double) == 100.5
    assert one(spark, "1.0f", G.soft_double) is None
    assert one(spark, "", G.soft_double) is None
    assert one(spark, "20123456789", G.soft_long) == 20123456789
    assert one(spark, "7790001234567.0", G.soft_long) == 7790001234567


@pytest.mark.parametrize("text, cleaned", [(" 1.0 ", "1"), ("1.00", "1"), ("10", "10"), ("1.05", "1.05"), ("  ", "")])
def test_clean_id(spark, text, cleaned):
    assert one(spark, text, G.clean_id) == cleaned


@pytest.mark.parametrize("text, value", [("", None), ("NULL", None), ("null", None), ("nulo", "nulo"), (None, None)])
def test_blank_to_null(spark, text, value):
    assert one(spark, text, G.blank_to_null) == value


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("DISC: LECHE", "LECHE"),
        ("HVDC LECHE", "LECHE"),
        ("DISC: HVDC LECHE", "LECHE"),
        ("HVDC DISC LECHE", "DISC LECHE"),
        ("UN DISC: LECHE", "UN DISC: LECHE"),
        ("DISCO", "DISCO"),
        (None, None),
    ],
)
def test_clean_description(spark, text, cleaned):
    assert one(spark, text, G.clean_description) == cleaned


@pytest.mark.parametrize(
    "text, category",
    [
        ("leche entera", "Lacteos"),
        ("CHOCOLATE BLANCO", "Infusiones"),
        ("DETERGENTE X", "Infusiones"),
        ("DETERGENTE", "Limpieza"),
        ("PASTA DENTAL", "Pastas"),
        ("TOMATE PELADO", "Infusiones"),
        ("CAFE", "Otros"),
        ("Café", "Infusiones"),
        ("ñoquis", "Pastas"),
        ("COCA LIGHT COLA", "Gaseosas"),
        ("TOALLA FEMENINA", "Higiene Personal"),
        ("PALITO SALADO", "Snacks"),
        ("CREMA", "Otros"),
        (None, "Otros"),
    ],
)
def test_categorize_product(spark, text, category):
    assert one(spark, text, G.categorize_product) == category


def test_exact_avg_does_not_depend_on_partitioning(spark):
    prices = spark.range(2000).select((F.col("id") * 0.01 + 0.1).alias("p"))
    results = {prices.repartition(n).agg(G.exact_avg(F.col("p"))).head()[0] for n in (1, 3, 7, 16)}
    assert results == {10.095}


def test_exact_avg_skips_nulls(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (2.0,)], "p double")
    assert rows.agg(G.exact_avg(F.col("p"))).head()[0] == 1.5


def test_business_date_and_weekday(spark):
    late = one(spark, datetime(2026, 1, 5, 2, 59), G.business_date, "timestamp_ntz")
    assert late == date(2026, 1, 4)
    assert one(spark, datetime(2026, 1, 5, 3, 0), G.business_date, "timestamp_ntz") == date(2026, 1, 5)
    assert one(spark, date(2026, 1, 5), G.weekday_name, "date") == "lunes"
    assert one(spark, date(2026, 1, 10), G.weekday_name, "date") == "sabado"


def test_footer(spark):
    assert one(spark, "Última actualización: 2026-01-15", G.is_footer) is True
    assert one(spark, "ULTIMA ACTUALIZACION", G.is_footer) is True
    assert one(spark, "Actualizado", G.is_footer) is False
    assert one(spark, None, G.is_footer) is False
    assert one(spark, "Ultima actualizacion: 2026-01-15T10", G.footer_date) == date(2026, 1, 15)
    assert one(spark, "Ultima actualizacion: 2026-02-31", G.footer_date) is None
