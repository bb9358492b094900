from datetime import date, datetime
from functools import reduce

import pytest
from conftest import child_zip, master_zip, merchant, product, store
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.operators import silver
from gondola.plans import daily, models, query, sinks
from gondola.schema import RAW_TABLES, SILVER, raw_columns
from gondola.sources import manifest, tables
from gondola.streaming.ingest import stream_ingest

D15, D16, D17 = date(2026, 1, 15), date(2026, 1, 16), date(2026, 1, 17)
NOW = datetime(2026, 1, 17, 12)


def day_frames(raw, products, **extra):
    return {
        "comercio": raw("comercio", merchant(), **extra),
        "sucursales": raw("sucursales", store(), **extra),
        "productos": raw("productos", *products, **extra),
    }


def bronze_products(spark, root, day=D15):
    return {r.id_producto for r in daily.bronze_rows(spark, root, "productos", day, day).collect()}


def test_bronze_day_is_all_or_nothing(spark, raw, tmp_path):
    root = str(tmp_path)
    incomplete = day_frames(raw, [product()]) | {"productos": raw("productos")}
    assert sinks.write_bronze_day(incomplete, root, D15) == {"comercio": 1, "sucursales": 1, "productos": 0}
    assert not sinks.day_exists(spark, root, D15)

    assert sinks.write_bronze_day(day_frames(raw, [product(), product(id_producto="2")]), root, D15)["productos"] == 2
    assert sinks.day_exists(spark, root, D15)
    assert not sinks.day_exists(spark, root, D15, force=True)
    assert bronze_products(spark, root) == {"100", "2"}

    sinks.write_bronze_day(incomplete, root, D15)
    assert sinks.day_exists(spark, root, D15) and bronze_products(spark, root) == {"100", "2"}

    failing = day_frames(raw, [product()])
    failing["productos"] = failing["productos"].withColumn("productos_ean", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_bronze_day(failing, root, D15)
    assert sinks.day_exists(spark, root, D15) and bronze_products(spark, root) == {"100", "2"}
    assert sinks.Folder(spark, f"{root}/bronze/.staging").children() == []

    sinks.write_bronze_day(day_frames(raw, [product(id_producto=str(i)) for i in range(3)]), root, D15)
    assert bronze_products(spark, root) == {"0", "1", "2"}


def test_a_day_without_its_marker_does_not_exist(spark, raw, tmp_path):
    root = str(tmp_path)
    sinks.write_bronze_day(day_frames(raw, [product()]), root, D15)
    sinks._marker(spark, root, D15).delete()
    assert not sinks.day_exists(spark, root, D15)


def test_archives_to_gold(spark, tmp_path):
    """Two days of archives through bronze, silver and every model; each step run twice."""
    root = str(tmp_path / "lake")
    for day in (D15, D16):
        goods = [product(), product(id_producto="200"), product(productos_precio_lista="-1"), product(id_sucursal="99")]
        children = [child_zip(day.isoformat(), goods), child_zip(day.isoformat(), goods, id_comercio="2"), b"junk"]
        master = master_zip(tmp_path / f"{day}.zip", children)
        rows = daily.ingest_day(spark, master, root, day).collect()
        assert {r.table_type: r.csv_row_count for r in rows} == {
            "bronze_comercio": 4,
            "bronze_sucursales": 2,
            "bronze_productos": 8,
        }
        assert {(r.malformed_zips_count, r.stale_count, r.unknown_count) for r in rows} == {(1, 0, 1)}
        assert daily.ingest_day(spark, master, root, day) is None
    assert daily.ingest_day(spark, master, root, D16, force=True) is not None

    for _ in range(2):
        stats = daily.load_days(spark, root, D15, D16, NOW)
        assert {tuple(r)[1:] for r in stats.collect()} == {(0, 2, 2, 0, 4)}
    fact = tables.scan(spark, models.table_path(root, "precios"), SILVER["precios"])
    assert fact.count() == 8
    assert {r.scraped_at for r in fact.collect()} == {NOW}
    dim = tables.scan(spark, models.table_path(root, "dim_productos"), SILVER["dim_productos"])
    assert {(r.fecha_vigencia, r.id_producto) for r in dim.collect()} == {
        (d, p) for d in (D15, D16) for p in ("100", "200")
    }

    counts = []
    for _ in range(2):
        counts.append({name: df.count() for name, df in models.build_all(spark, root).items()})
    assert counts[0] == counts[1]
    assert counts[0]["fct_price_quotes"] == 8 and counts[0]["gold_price_hypothesis"] == 8
    assert counts[0]["gold_price_timeseries"] == 4 and counts[0]["mart_store_coverage"] == 2
    assert counts[0]["gold_cross_price_elasticity"] == 0  # no chain has three observations


def test_stale_package_is_refused(spark, tmp_path):
    children = [child_zip("2026-01-13", [product()])] * 3 + [child_zip("2026-01-15", [product()])] * 2
    master = master_zip(tmp_path / "m.zip", children)
    with pytest.raises(daily.StalePackage):
        daily.ingest_day(spark, master, str(tmp_path / "lake"), D15)
    assert not sinks.day_exists(spark, str(tmp_path / "lake"), D15)


def test_range_must_be_ordered(spark, tmp_path):
    with pytest.raises(ValueError):
        daily.load_days(spark, str(tmp_path), D16, D15)


def silver_rows(raw, day, *products):
    from gondola.operators.clean import clean_productos

    frame = raw("productos", *products, fecha_vigencia=day)
    return silver.stamp(silver.to_silver_precios(clean_productos(frame)), scraped_at=NOW)


def test_replacing_a_day_leaves_the_others(spark, raw, tmp_path):
    path = str(tmp_path / "precios")
    sinks.replace_days(silver_rows(raw, D15, product()).unionByName(silver_rows(raw, D16, product())), path, "precios")
    for _ in range(2):
        sinks.replace_days(silver_rows(raw, D16, product(), product(id_producto="2")), path, "precios")
    rows = tables.scan(spark, path, SILVER["precios"])
    assert {r[0]: r[1] for r in rows.groupBy("fecha_vigencia").count().collect()} == {D15: 1, D16: 2}


def test_a_reload_without_good_rows_empties_its_day(spark, raw, tmp_path):
    root = str(tmp_path)
    both = [day_frames(raw, [product()], fecha_vigencia=d) for d in (D15, D16)]
    daily.load_silver({t: both[0][t].unionByName(both[1][t]) for t in RAW_TABLES}, root, NOW)
    bad = day_frames(raw, [product(productos_precio_lista="-1")], fecha_vigencia=D16)
    stats = daily.load_silver(bad, root, NOW).collect()
    assert [(r.negative_price_count, r.silver_loaded) for r in stats] == [(1, 0)]
    for name in ("precios", "dim_productos"):
        rows = tables.scan(spark, models.table_path(root, name), SILVER[name]).collect()
        assert [r.fecha_vigencia for r in rows] == [D15]


def test_each_table_loses_the_dates_it_got_nothing_for(spark, raw, tmp_path):
    root = str(tmp_path)

    def dates(name):
        rows = tables.scan(spark, models.table_path(root, name), SILVER[name]).select("fecha_vigencia").distinct()
        return {r[0] for r in rows.collect()}

    both = [day_frames(raw, [product()], fecha_vigencia=d) for d in (D15, D16)]
    daily.load_silver({t: both[0][t].unionByName(both[1][t]) for t in RAW_TABLES}, root, NOW)
    assert all(dates(name) == {D15, D16} for name in SILVER)
    # The day comes again with merchants only: no store is valid and no price row exists.
    again = both[1] | {t: both[1][t].filter("false") for t in ("sucursales", "productos")}
    daily.load_silver(again, root, NOW)
    assert dates("dim_comercios") == {D15, D16}
    assert all(dates(name) == {D15} for name in ("dim_sucursales", "precios", "dim_productos"))


def bronze_prices(spark, root, *days):
    return {d: {r.productos_precio_lista for r in daily.bronze_rows(spark, root, "productos", d, d).collect()} for d in days}


@pytest.mark.parametrize("whole_range", [False, True])
@pytest.mark.parametrize("point", ["comercio", "productos", "commit"])
def test_a_failure_at_any_point_leaves_all_earlier_days(spark, raw, tmp_path, monkeypatch, whole_range, point):
    root, days = str(tmp_path), (D15, D16, D17) if whole_range else (D15,)

    def write(price, broken=None):
        parts = [day_frames(raw, [product(productos_precio_lista=price)], fecha_vigencia=d) for d in days]
        frames = {t: reduce(DataFrame.unionByName, [p[t] for p in parts]) for t in RAW_TABLES}
        if broken:  # fails in the task that writes the last day
            column = raw_columns(broken)[0]
            bad = F.when(F.col("fecha_vigencia") == days[-1], F.raise_error(F.lit("no space")).cast("string"))
            frames[broken] = frames[broken].withColumn(column, bad.otherwise(F.col(column)))
        if whole_range:
            sinks.write_bronze_range(frames, root)
        else:
            sinks.write_bronze_day({t: df.drop("fecha_vigencia") for t, df in frames.items()}, root, D15)

    write("1")
    before = sorted(p for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".crc")
    with monkeypatch.context() as patched:
        if point == "commit":

            def failing(self, target):
                raise OSError("no space")

            patched.setattr(sinks.Folder, "move_to", failing)
        with pytest.raises(Exception, match="no space"):
            write("2", None if point == "commit" else point)
    assert sorted(p for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".crc") == before
    assert all(sinks.day_exists(spark, root, d) for d in days)
    assert bronze_prices(spark, root, *days) == {d: {"1"} for d in days}
    for price in ("3", "4", "5"):
        write(price)
        assert bronze_prices(spark, root, *days) == {d: {price} for d in days}
    # The files of the version before stay for its readers, older ones go.
    assert len(list(tmp_path.rglob("day=15/*.parquet"))) == 2 * len(RAW_TABLES)


def test_a_reader_keeps_the_version_it_found(spark, raw, tmp_path):
    root = str(tmp_path)
    write = lambda price: sinks.write_bronze_day(day_frames(raw, [product(productos_precio_lista=price)]), root, D15)
    write("1")
    found = daily.bronze_rows(spark, root, "productos", D15, D15)
    write("2")
    assert {r.productos_precio_lista for r in found.collect()} == {"1"}
    assert bronze_prices(spark, root, D15, D16) == {D15: {"2"}, D16: set()}


def test_a_version_is_taken_once(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    sinks.write_bronze_day(day_frames(raw, [product()]), root, D15)
    versions = manifest._versions
    monkeypatch.setattr(manifest, "_versions", lambda *a: versions(*a)[:-1])  # as the slower of two writers saw it
    with pytest.raises(FileExistsError):
        sinks.write_bronze_day(day_frames(raw, [product(id_producto="9")]), root, D15)
    monkeypatch.setattr(manifest, "_versions", versions)
    assert bronze_products(spark, root) == {"100"}


def test_a_range_touches_only_its_days(spark, raw, tmp_path):
    root = str(tmp_path)
    both = [day_frames(raw, [product()], fecha_vigencia=d) for d in (D15, D16)]
    sinks.write_bronze_range({t: both[0][t].unionByName(both[1][t]) for t in RAW_TABLES}, root)
    marker = tmp_path / "bronze/_committed/year=2026/month=01/day=15/_SUCCESS"
    before = marker.stat().st_mtime_ns
    sinks.write_bronze_range(day_frames(raw, [product(productos_precio_lista="7")], fecha_vigencia=D16), root)
    assert marker.stat().st_mtime_ns == before
    assert bronze_prices(spark, root, D15, D16) == {D15: {"1500.50"}, D16: {"7"}}


def test_an_upsert_without_dates_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(coverage(spark, (D15, "A", 1)), path, ["fecha_vigencia", "provincia"])
    with pytest.raises(ValueError, match="no fecha_vigencia"):
        sinks.upsert(coverage(spark, (None, "A", 1)), path, ["fecha_vigencia", "provincia"])


def test_the_audit_counts_what_was_read_apart_from_what_was_written(spark, tmp_path, monkeypatch):
    master = master_zip(tmp_path / "m.zip", [child_zip("2026-01-15", [product(), product(id_producto="2")])])
    lost = daily.bronze_rows
    monkeypatch.setattr(
        daily, "bronze_rows", lambda s, r, t, a, b: lost(s, r, t, a, b).limit(1) if t == "productos" else lost(s, r, t, a, b)
    )
    rows = {r.table_type: r for r in daily.ingest_day(spark, master, str(tmp_path / "lake"), D15).collect()}
    assert (rows["bronze_productos"].csv_row_count, rows["bronze_productos"].parquet_row_count) == (2, 1)
    assert (rows["bronze_comercio"].csv_row_count, rows["bronze_comercio"].parquet_row_count) == (2, 2)


def test_a_full_build_drops_vanished_dates(spark, raw, tmp_path):
    path = str(tmp_path / "quotes")
    model = models.MODELS[0]
    rows = silver_rows(raw, D15, product()).unionByName(silver_rows(raw, D16, product()))
    models.run_model(spark, model, {"precios": rows}, path)
    kept = models.run_model(spark, model, {"precios": rows.filter(F.col("fecha_vigencia") == D15)}, path)
    assert kept.count() == 2
    assert models.run_model(spark, model, {"precios": silver_rows(raw, D15, product())}, path, full=True).count() == 1


def test_fan_out_writes_every_target(raw, spark, tmp_path):
    rows = silver_rows(raw, D15, product())
    paths = [str(tmp_path / n) for n in "ab"]
    sinks.fan_out(rows, [lambda df, p=p: sinks.replace_days(df, p) for p in paths])
    assert [spark.read.parquet(p).count() for p in paths] == [1, 1]


def test_files_are_sized_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 100)
    rows = spark.range(250).select("id", F.lit(D15).alias("fecha_vigencia"))
    sinks.replace_days(rows, str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "fecha_vigencia=2026-01-15").glob("*.parquet"))) == 3


def coverage(spark, *rows):
    return spark.createDataFrame(list(rows), "fecha_vigencia date, provincia string, n int")


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["fecha_vigencia", "provincia"]
    sinks.upsert(coverage(spark, (D15, "A", 1), (D15, None, 1), (D16, "A", 1)), path, keys)
    batch = coverage(spark, (D15, None, 2), (D15, "B", 2), (D17, "A", 2))
    for _ in range(2):
        sinks.upsert(batch, path, keys)
    found = {tuple(r) for r in spark.read.parquet(path).select("fecha_vigencia", "provincia", "n").collect()}
    assert found == {(D15, "A", 1), (D15, None, 2), (D15, "B", 2), (D16, "A", 1), (D17, "A", 2)}


def test_late_rows_within_the_lookback_are_picked_up(spark):
    rows = coverage(spark, *[(date(2026, 1, d), "A", d) for d in range(10, 18)])
    kept = models.incremental_rows(rows, models.high_water_mark(rows))
    assert sorted(r.n for r in kept.collect()) == [15, 16, 17]
    assert models.high_water_mark(rows.filter("false")) == date(2000, 1, 1)


def test_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = coverage(spark, *[(date(2026, 1, d), "A", d) for d in (1, 10, 20)])
    sinks.replace_days(rows, path)
    plan = sinks.retention_plan(spark.read.parquet(path), date(2026, 1, 21), keep_days=11)
    assert {r.fecha_vigencia.day: r.borrar for r in plan.collect()} == {1: True, 10: False, 20: False}
    assert sinks.drop_old_days(spark, path, date(2026, 1, 21), keep_days=11) == ["2026-01-01"]
    assert spark.read.parquet(path).count() == 2


def test_stream_runs_again_for_what_comes_later(spark, raw, tmp_path):
    root, arrivals, progress = (str(tmp_path / n) for n in ("lake", "arrivals", "progress"))
    stores = silver.to_silver_sucursales(
        daily.validated(day_frames(raw, [product()], fecha_vigencia=D15))["sucursales"]
    )
    sinks.replace_days(stores, models.table_path(root, "dim_sucursales"))

    def arrive(*products):
        frame = raw("productos", *products, fecha_vigencia=D15)
        tables.with_day_parts(frame).drop("fecha_vigencia").write.mode("append").partitionBy(
            *tables.DAY_PARTS
        ).parquet(arrivals)
        stream_ingest(spark, arrivals, root, progress).awaitTermination()
        fact = tables.scan(spark, models.table_path(root, "precios"), SILVER["precios"])
        return {(r.id_producto, r.precio_lista) for r in fact.collect()}

    assert arrive(product(), product(id_sucursal="99")) == {("100", 1500.5)}
    assert arrive(product(id_producto="2")) == {("100", 1500.5), ("2", 1500.5)}
    assert arrive(product(productos_precio_lista="9")) == {("100", 9.0), ("2", 1500.5)}


def test_guarded_query(spark):
    lake = {"precios": spark.range(20), "precios_extra": spark.range(3)}
    assert query.guarded_query(spark, "select id from LAKE.precios", lake, limit=7).count() == 7
    joined = "SELECT p.id FROM lake.precios p JOIN lake.precios_extra e ON p.id = e.id -- note"
    assert query.guarded_query(spark, joined, lake).count() == 3
    assert query.guarded_query(spark, "WITH x AS (SELECT 1 AS a) SELECT a FROM x", lake).count() == 1
    assert query.guarded_query(spark, "SELECT explode(sequence(1, 6000)) AS a", lake).count() == 6000
    nested = "SELECT (SELECT max(id) FROM lake.precios) m, 'lake.precios' t FROM precios_extra WHERE id IN (SELECT id FROM precios)"
    assert {tuple(r) for r in query.guarded_query(spark, nested, lake).collect()} == {(19, "lake.precios")}
    spark.range(1).createOrReplaceTempView("precios")
    assert query.guarded_query(spark, "SELECT * FROM precios", lake).count() == 20
    assert spark.table("precios").count() == 1  # the caller's view of that name stays
    for sql in ("DROP TABLE precios", "INSERT INTO precios VALUES (1)", "", "-- SELECT 1\nDROP VIEW precios"):
        with pytest.raises(ValueError):
            query.guarded_query(spark, sql, lake)
    for sql in (
        "SELECT 1; DROP VIEW precios",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "WITH x AS (SELECT java_method('a', 'b')) SELECT * FROM x",
        "SELECT * FROM parquet.`/tmp/x`",
        "SELECT * FROM otra",
        "SELECT * FROM otro.precios",
        "SELECT id FROM precios WHERE id IN (SELECT id FROM otra)",
        "SET spark.sql.ansi.enabled = false",
    ):
        with pytest.raises(ValueError):
            query.guarded_query(spark, sql, lake)


def test_preview_and_catalog(spark):
    lake = {"precios": spark.range(80)}
    assert query.preview_table(spark, "lake.precios", lake).count() == 50
    with pytest.raises(ValueError, match="unknown table"):
        query.preview_table(spark, "lake.otra", lake)
    assert "precios" in {r.tabla for r in query.list_tables(spark).collect()}
    assert "default" in {r.namespace for r in query.list_namespaces(spark).collect()}


def test_raw_tables_cover_the_bronze_layout():
    assert set(RAW_TABLES) == {"comercio", "sucursales", "productos"}
