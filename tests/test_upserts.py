"""Upserts by file and the stream that is made of them."""

import random
from datetime import date
from pathlib import Path

import pytest
from conftest import product, store
from pyspark.sql import functions as F

from gondola.operators import silver
from gondola.plans import daily, models, sinks
from gondola.schema import SILVER
from gondola.sources import tables
from gondola.streaming import ingest

D15, D16 = date(2026, 1, 15), date(2026, 1, 16)
SCHEMA = "k int, g string, v double, fecha_vigencia date"


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "/." not in str(p)}


def content(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    """100 keys a day in ten files by key, two days."""
    path = str(tmp_path / "t able")
    rows = spark.createDataFrame([(i, None if i % 10 == 3 else "g", float(i), d) for d in (D15, D16) for i in range(100)], SCHEMA)
    rows.repartitionByRange(10, "k").sortWithinPartitions("k").write.partitionBy("fecha_vigencia").parquet(path)
    return path


def test_only_files_with_a_key_of_the_batch_are_rewritten(spark, table):
    before = files(table)
    assert len(before) == 20
    batch = [(13, None, -1.0, D15), (14, "g", -2.0, D15), (500, "g", 5.0, D15)]
    sinks.upsert(spark.createDataFrame(batch, SCHEMA), table, ["k", "g", "fecha_vigencia"])
    after = files(table)
    kept = before.items() & after.items()
    assert len(kept) == 19 and {p.parent.name for p in set(before) - set(dict(kept))} == {"fecha_vigencia=2026-01-15"}
    rows = content(spark, table)
    assert len(rows) == 201 and set(batch) < set(rows) and (13, None, 13.0, D15) not in rows and (13, None, 13.0, D16) in rows
    assert not [p for p in Path(table).iterdir() if p.name.startswith((".staging", "_pending"))]


def test_new_keys_are_appended(spark, table):
    before = files(table)
    sinks.upsert(spark.createDataFrame([(1000, "g", 1.0, D15)], SCHEMA), table, ["k", "g", "fecha_vigencia"])
    assert before.items() < files(table).items() and len(content(spark, table)) == 201


@pytest.mark.parametrize("stop", [0, 1, 2, 3])
def test_an_interrupted_upsert_is_finished_by_the_next(spark, table, monkeypatch, stop):
    batch = spark.createDataFrame([(13, None, -1.0, D15), (99, "g", -2.0, D16)], SCHEMA)
    calls = []

    def failing(method):
        def run(self, *args):
            # After the journal is there: at the first moves, then at the first deletes.
            if sinks.Folder(spark, f"{table}/_pending").exists() and "draft" not in self.path:
                calls.append(self.path)
                if len(calls) > stop:
                    raise OSError("lost")
            return method(self, *args)

        return run

    with monkeypatch.context() as patched:
        for name in ("move_to", "delete"):
            patched.setattr(sinks.Folder, name, failing(getattr(sinks.Folder, name)))
        with pytest.raises(OSError, match="lost"):
            sinks.upsert(batch, table, ["k", "g", "fecha_vigencia"])
    sinks.upsert(spark.createDataFrame([], SCHEMA), table, ["k", "g", "fecha_vigencia"])
    rows = content(spark, table)
    assert len(rows) == 200 and (13, None, -1.0, D15) in rows and (99, "g", -2.0, D16) in rows


def test_many_upserts_equal_one_table(spark, table):
    rng, expected = random.Random(2), {(i, None if i % 10 == 3 else "g", d): float(i) for d in (D15, D16) for i in range(100)}
    for step in range(6):
        batch = {(rng.randrange(120), rng.choice(("g", None)), rng.choice((D15, D16))): float(-step) for _ in range(7)}
        sinks.upsert(spark.createDataFrame([(k, g, v, d) for (k, g, d), v in batch.items()], SCHEMA), table, ["k", "g", "fecha_vigencia"])
        expected |= batch
    assert content(spark, table) == sorted(((k, g, v, d) for (k, g, d), v in expected.items()), key=str)
    schema = spark.read.schema(SCHEMA).parquet(table).schema
    assert sinks.compact_days(spark, table, schema, most_files=3) == ["2026-01-15", "2026-01-16"]
    assert content(spark, table) == sorted(((k, g, v, d) for (k, g, d), v in expected.items()), key=str)
    assert sinks.compact_days(spark, table, schema, most_files=3) == [] and len(files(table)) <= 6


@pytest.fixture
def lake(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    frames = {"comercio": raw("comercio", {"id_comercio": "1", "id_bandera": "1"}, fecha_vigencia=D15), "sucursales": raw("sucursales", store(), fecha_vigencia=D15), "productos": raw("productos", product(), fecha_vigencia=D15)}
    sinks.replace_days(silver.to_silver_sucursales(daily.validated(frames)["sucursales"]), models.table_path(root, "dim_sucursales"))
    return root


def arrive(spark, raw, path, *products, **extra):
    frame = raw("productos", *products, fecha_vigencia=D15)
    tables.with_day_parts(frame).drop("fecha_vigencia").write.mode("append").partitionBy(*tables.DAY_PARTS).parquet(path)


def fact(spark, root):
    return tables.scan(spark, models.table_path(root, "precios"), SILVER["precios"])


def test_late_rows_write_what_they_are_and_replays_nothing(spark, raw, tmp_path, lake):
    arrivals, progress = str(tmp_path / "arrivals"), str(tmp_path / "progress")
    arrive(spark, raw, arrivals, *[product(id_producto=str(i)) for i in range(1000)])
    ingest.stream_ingest(spark, arrivals, lake, progress).awaitTermination()
    path = models.table_path(lake, "precios")
    before = files(path)
    arrive(spark, raw, arrivals, *[product(id_producto=str(i)) for i in range(1000, 1010)], product(id_sucursal="99"))
    ingest.stream_ingest(spark, arrivals, lake, progress).awaitTermination()
    new = files(path).keys() - before.keys()
    assert before.items() < files(path).items()
    assert spark.read.parquet(*map(str, new)).count() == 10 and fact(spark, lake).count() == 1010
    counts = sorted(map(tuple, ingest.loaded_batches(spark, lake, progress).collect()))
    assert counts == [(0, 1000, 1000, D15, 1000), (1, 11, 10, D15, 10)]

    # The same batch again, as after a failure before the checkpoint: recorded, so nothing is written.
    after = files(path)
    replay = raw("productos", product(id_producto="5", productos_precio_lista="1"), fecha_vigencia=D15)
    ingest.load_batch(replay, lake, 1, ingest.ledger_path(lake, progress))
    assert files(path) == after


def test_a_batch_that_failed_before_its_record_leaves_the_same_rows(spark, raw, tmp_path, lake):
    ledger = ingest.ledger_path(lake, "c")
    batch = raw("productos", product(id_producto="1"), product(id_producto="2"), fecha_vigencia=D15)
    ingest.load_batch(batch, lake, 0, ledger)
    rows = fact(spark, lake).select(F.col("id_producto")).collect()
    sinks.Folder(spark, f"{ledger}/lote=000000000").delete()  # as if it had stopped between the two
    ingest.load_batch(batch, lake, 0, ledger)
    assert sorted(fact(spark, lake).select("id_producto").collect()) == sorted(rows)
    assert ingest.loaded_batches(spark, lake, "c").count() == 1
