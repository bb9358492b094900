from datetime import date, datetime, timezone

import pytest
from conftest import merchant, product, store
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gondola.operators import audit, clean, integrity, silver
from gondola.schema import MERCHANT_KEYS, STORE_KEYS, raw_schema, silver_schema

DAY = {"fecha_vigencia": date(2026, 1, 15)}


def test_comercio_types_and_keys(raw):
    rows = clean.clean_comercio(
        raw(
            "comercio",
            merchant(id_comercio=" 1.0 ", id_bandera="1.0", comercio_cuit="20", comercio_version_sepa="1.5"),
            merchant(id_comercio="2\x00", id_bandera="x"),
            merchant(id_comercio="  "),
            merchant(id_comercio="Última actualización: 2026-01-15"),
            merchant(id_comercio=None),
        )
    ).collect()
    assert [(r.id_comercio, r.id_bandera, r.comercio_cuit, r.comercio_version_sepa) for r in rows] == [("1", 1, 20, 1.5)]


def test_nul_characters_go(raw):
    row = clean.clean_comercio(raw("comercio", merchant(id_comercio="2\x00\x00", comercio_bandera_nombre="A\x00B"))).head()
    assert (row.id_comercio, row.comercio_bandera_nombre) == ("2", "AB")


def test_missing_columns_raise(raw):
    with pytest.raises(ValueError, match="comercio_cuit"):
        clean.clean_comercio(raw("comercio", merchant()).drop("comercio_cuit"))


def test_store_type_is_kept_and_reported(raw):
    stores = clean.clean_sucursales(
        raw(
            "sucursales",
            store(sucursales_tipo=" WEB ", id_comercio="1.0"),
            store(id_sucursal="11", sucursales_tipo="Kiosco"),
            store(id_sucursal="12", sucursales_tipo="kiosco"),
            store(id_sucursal="13", sucursales_tipo=None),
            store(id_sucursal="14", sucursales_localidad=None),
            store(id_sucursal="x"),
            store(id_comercio="Ultima actualizacion: 2026-01-15"),
        )
    )
    assert {(r.id_sucursal, r.id_comercio, r.sucursales_tipo) for r in stores.collect()} == {
        (10, "1", "web"),
        (11, "1", "kiosco"),
        (12, "1", "kiosco"),
        (13, "1", None),
    }
    assert clean.unknown_store_types(stores).head().asDict() == {"filas": 2, "tipos": 1, "muestras": "kiosco"}


def test_no_unknown_store_types(raw):
    row = clean.unknown_store_types(clean.clean_sucursales(raw("sucursales", store()))).head()
    assert (row.filas, row.tipos) == (0, 0)


@pytest.mark.parametrize(
    "flag, value", [("1", True), ("True", True), ("0", False), ("false", False), ("", False), ("si", None), (None, None)]
)
def test_code_flag(raw, flag, value):
    assert clean.clean_productos(raw("productos", product(productos_ean=flag))).head().productos_ean is value


def tagged(raw):
    return clean.tag_productos(
        raw(
            "productos",
            product(),
            product(productos_precio_lista="-50"),
            product(productos_precio_lista="0"),
            product(productos_precio_lista="n/d"),
            product(productos_descripcion=None),
            product(id_producto="SKU"),
            product(id_producto="Ultima actualizacion: 2026-01-15"),
            product(id_sucursal="99"),
            **DAY,
        )
    )


def stores(raw, *rows):
    return clean.clean_sucursales(raw("sucursales", *rows, **DAY))


def test_each_row_is_rejected_for_its_first_reason(raw):
    rows = integrity.tag_orphans(tagged(raw), stores(raw, store()), STORE_KEYS)
    counts = {r[0]: r[1] for r in rows.groupBy(clean.REJECT).count().collect()}
    assert counts == {None: 1, "validation": 3, "price": 2, "footer": 1, "integrity": 1}
    stats = audit.drop_stats(rows).head()
    assert stats.asDict() == DAY | {
        "validation_dropped": 3,
        "integrity_dropped": 1,
        "negative_price_count": 2,
        "absurd_price_count": 0,
        "silver_loaded": 1,
    }


def test_counters_observed_on_the_write_are_the_same(raw, tmp_path):
    rows = integrity.tag_orphans(tagged(raw), stores(raw, store()), STORE_KEYS)
    seen = Observation("drops")
    clean.kept(audit.observe_drops(rows, seen)).write.parquet(str(tmp_path / "kept"))
    assert seen.get == {k: v for k, v in audit.drop_stats(rows).head().asDict().items() if k != "fecha_vigencia"}


def test_without_stores_all_prices_stay(raw):
    empty = stores(raw, store()).filter("false")
    rows = integrity.tag_orphans(tagged(raw), empty, STORE_KEYS, spare_uncovered=True)
    assert clean.kept(rows).count() == 2
    good = clean.kept(tagged(raw))
    assert integrity.keep_matching(good, empty, STORE_KEYS, scope=(), spare_uncovered=True).count() == 2
    assert integrity.uncovered_dates(good, empty).collect() == [(DAY["fecha_vigencia"], 2)]
    assert integrity.keep_matching(good, empty, STORE_KEYS).isEmpty()
    assert clean.kept(integrity.tag_orphans(tagged(raw), empty, STORE_KEYS)).isEmpty()


@pytest.mark.parametrize("price", ["NaN", "Infinity", "1e16", "1e300"])
def test_absurd_prices_are_a_counted_reject(raw, price):
    rows = clean.tag_productos(raw("productos", product(productos_precio_lista=price), product(), **DAY))
    assert [r[clean.REJECT] for r in rows.collect()] == ["absurd", None]
    stats = audit.drop_stats(rows).head()
    assert (stats.absurd_price_count, stats.silver_loaded, stats.validation_dropped) == (1, 1, 0)
    audited = audit.silver_audit(audit.drop_stats(rows), datetime(2026, 1, 16)).head()
    assert audited.validation_dropped == 1


def test_the_empty_side_rule_is_per_day(raw, spark):
    other = {"fecha_vigencia": date(2026, 1, 16)}
    rows = clean.clean_productos(raw("productos", product(id_sucursal="99"), **DAY)).unionByName(
        clean.clean_productos(raw("productos", product(id_sucursal="99"), **other))
    )
    kept = integrity.keep_matching(rows, stores(raw, store()), STORE_KEYS, spare_uncovered=True)
    assert [r.fecha_vigencia for r in kept.collect()] == [date(2026, 1, 16)]


def test_orphans(raw):
    merchants = clean.clean_comercio(raw("comercio", merchant(), **DAY))
    both = stores(raw, store(), store(id_comercio="2", id_sucursal="20"))
    assert integrity.orphan_keys(both, merchants, MERCHANT_KEYS).collect() == [("2", 1)]
    assert [r.id_sucursal for r in integrity.keep_matching(both, merchants, MERCHANT_KEYS).collect()] == [10]


def test_merged_dimensions_are_distinct(raw):
    frames = [raw("comercio", merchant(), merchant(id_comercio="2")), raw("comercio", merchant(id_comercio="1.0"))]
    assert clean.merge_dimension(frames, clean.clean_comercio).count() == 2


def test_silver_prices(raw):
    rows = clean.clean_productos(raw("productos", product(productos_precio_lista="100.5", extra_column="x")))
    out = silver.to_silver_precios(rows.withColumn("extra_column", F.lit("x")))
    row = out.head()
    assert (row.ean, row.precio_lista, row.marca, row.id_producto, row.id_sucursal) == (True, 100.5, "S/D", "100", "10")
    expected = [f for f in silver_schema("precios").fields if f.name not in ("fecha_vigencia", "scraped_at")]
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in expected]


def test_missing_columns_become_typed_nulls(spark):
    out = silver.to_silver_precios(spark.createDataFrame([("1", "5.5")], "id_comercio string, productos_precio_lista string"))
    row = out.head()
    assert (row.precio_lista, row.marca, row.ean) == (5.5, None, None)


def test_silver_stores(raw):
    rows = stores(raw, store(sucursales_provincia="Buenos Aires", sucursales_latitud="-34.6", sucursales_longitud="s/d"))
    row = silver.to_silver_sucursales(rows).head()
    assert (row.provincia, row.latitud, row.longitud, row.fecha_vigencia) == ("AR-B", -34.6, None, date(2026, 1, 15))


def test_silver_merchants(raw):
    row = silver.to_silver_comercios(clean.clean_comercio(raw("comercio", merchant(comercio_cuit="20")))).head()
    assert (row.cuit, row.bandera_nombre) == ("20", "Uno")


def test_first_product_row_does_not_depend_on_order(raw):
    rows = clean.clean_productos(
        raw("productos", product(productos_marca="B"), product(productos_marca="A"), product(id_producto="2"), **DAY)
    )
    for parts in (1, 5):
        kept = integrity.distinct_products(silver.to_silver_productos(rows.repartition(parts)))
        assert {(r.id_producto, r.marca) for r in kept.collect()} == {("100", "A"), ("2", "S/D")}


def test_stamp_drops_the_zone(raw):
    when = datetime(2026, 1, 15, 10, tzinfo=timezone.utc)
    row = silver.stamp(raw("comercio", merchant()), "2026-01-15", when).head()
    assert (row.fecha_vigencia, row.scraped_at) == (date(2026, 1, 15), datetime(2026, 1, 15, 10))


def test_unknown_tables_raise():
    with pytest.raises(ValueError):
        raw_schema("ventas")
    with pytest.raises(ValueError):
        silver_schema("ventas")
