import io
import zipfile
from datetime import date

import pytest
from conftest import child_zip, csv_text, master_zip, product
from pyspark.sql import functions as F

from gondola.operators import freshness
from gondola.schema import raw_columns
from gondola.sources import archives, pages, raw_csv, tables


def test_one_header(spark, tmp_path):
    header = "﻿id_comercio | id_bandera |comercio_cuit"
    body = "1|2|3\n4||NULL\n5|null\n6|7|8|surplus\n"
    (tmp_path / "a.csv").write_bytes(f"{header}\n{body}".encode() + b'9|"q"|\xff\n')
    df = raw_csv.read_raw_csv(spark, str(tmp_path))
    assert df.columns == ["id_comercio", "id_bandera", "comercio_cuit"]
    assert sorted(map(tuple, df.collect())) == [
        ("1", "2", "3"),
        ("4", None, None),
        ("5", None, None),
        ("6", "7", "8"),
        ("9", '"q"', "�"),
    ]


def test_another_header_fails_instead_of_mixing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_comercio|id_bandera\n1|2\n" * 1)
    (tmp_path / "b.csv").write_text("id_bandera|id_comercio\n2|1\n")
    with pytest.raises(Exception, match="header"):
        raw_csv.read_raw_csv(spark, str(tmp_path)).collect()


def test_headers_in_any_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿" + csv_text("productos", [product()]), encoding="utf-8")
    few = ["productos_precio_lista", "id_bandera", "otra", "id_comercio", "id_producto"]
    (tmp_path / "b.csv").write_text(csv_text("productos", [product(id_producto="200", otra="x")], few))
    (tmp_path / "c.csv").write_bytes(csv_text("productos", [product(id_producto="300")], few[::-1]).replace("\n", "\r\n").encode())
    df = raw_csv.read_by_name(spark, str(tmp_path), "productos")
    assert df.columns == list(raw_columns("productos"))
    rows = {r.id_producto: (r.id_comercio, r.productos_precio_lista, r.id_sucursal) for r in df.collect()}
    assert rows == {"100": ("1", "1500.50", "10"), "200": ("1", "1500.50", None), "300": ("1", "1500.50", None)}


def test_a_header_is_the_first_line_whatever_it_says(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_comercio|comercio_cuit|comercio_razon_social\n7|30|SA\n")
    (tmp_path / "b.csv").write_text("id_bandera|id_comercio\n\n1|2\nid_comercio y id_bandera|9\n 3 |4\n")
    df = raw_csv.read_by_name(spark, str(tmp_path), "comercio")
    assert sorted((r.id_comercio, r.id_bandera or "", r.comercio_cuit or "") for r in df.collect()) == [
        ("2", "1", ""),
        ("4", " 3 ", ""),
        ("7", "", "30"),
        ("9", "id_comercio y id_bandera", ""),
    ]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_file_without_a_known_column_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("uno|dos\n1|2\n")
    with pytest.raises(Exception, match="names no column"):
        raw_csv.read_by_name(spark, str(tmp_path), "comercio").collect()


def test_a_large_file_is_read_by_many_tasks_without_python(spark, tmp_path):
    rows = [product(id_producto=str(i), productos_descripcion="Pan " * 20) for i in range(5000)]
    few = ["id_producto", "productos_precio_lista", "id_comercio"]
    (tmp_path / "dos archivos").mkdir()
    (tmp_path / "dos archivos" / "a [1].csv").write_text("\n \n" + csv_text("productos", rows))
    (tmp_path / "dos archivos" / "b.csv").write_text(csv_text("productos", [product(id_producto=f"b{i}") for i in range(3)], few))
    (tmp_path / "dos archivos" / "empty.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64 * 1024)
    try:
        df = raw_csv.read_by_name(spark, str(tmp_path / "dos archivos"), "productos", keep_path=True)
        assert df.rdd.getNumPartitions() > 8
        found = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.id_producto for r in found) == sorted([str(i) for i in range(5000)] + ["b0", "b1", "b2"])
    assert all((r.id_bandera is None) == r.id_producto.startswith("b") and r.productos_precio_lista == "1500.50" for r in found)
    assert {r.path.rsplit("/", 1)[1] for r in found} == {"a%20%5B1%5D.csv", "b.csv"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Exchange" not in plan


def test_compressed_files_have_headers_too(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress("id_bandera|id_comercio\n1|2\n".encode()))
    (tmp_path / "b.csv").write_text("id_comercio|id_bandera\r\n4|3\r\n")
    rows = raw_csv.read_by_name(spark, str(tmp_path), "comercio").select("id_comercio", "id_bandera").collect()
    assert sorted(map(tuple, rows)) == [("2", "1"), ("4", "3")]


def test_headers_of_many_files_are_literals_of_one_scan(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text("id_bandera|id_comercio\n1|2\n" if i % 2 else "id_comercio|extra|id_bandera\n2|x|1\n")
    df = raw_csv.read_by_name(spark, str(tmp_path), "comercio")
    assert {tuple(r) for r in df.select("id_comercio", "id_bandera").collect()} == {("2", "1")} and df.count() == 30
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def damaged(child: bytes, how: str) -> bytes:
    with zipfile.ZipFile(io.BytesIO(child)) as whole:
        info = whole.getinfo("productos.csv")
        at = info.header_offset + 30 + len(info.filename)
    out = bytearray(child)
    if how == "checksum":
        found = out.index(info.CRC.to_bytes(4, "little"), info.header_offset + 30)
        out[found : found + 4] = b"\0\0\0\1"
    elif how == "data":
        out[at : at + 3] = b"\xff\xff\xff"
    else:
        del out[at : at + 20]
    return bytes(out)


def packed(child: bytes) -> bytes:
    """The same child with compressed members."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(child)) as old, zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            new.writestr(name, old.read(name))
    return buffer.getvalue()


@pytest.mark.parametrize("how", ["checksum", "data", "truncated"])
def test_a_damaged_member_makes_its_child_malformed(spark, tmp_path, how):
    good = packed(child_zip("2026-01-15", [product(id_producto="5")]))
    bad = damaged(packed(child_zip("2026-01-15", [product()])), how)
    master_zip(tmp_path / "m.zip", [good, bad, packed(child_zip("2026-01-15", [product(id_producto="6")]))])
    found = archives.split_masters(archives.read_masters(spark, str(tmp_path)), "child_*.zip")
    assert {r.child[-5]: r.status for r in archives.child_status(found).collect()} == {"0": "ok", "1": "malformed", "2": "ok"}
    rows = archives.table_rows(archives.member_lines(found), "productos").collect()
    assert sorted(r.id_producto for r in rows) == ["5", "6"]


def test_layout():
    assert raw_csv.layout("﻿ id_bandera |x|id_comercio", "comercio") == [2, 0] + [-1] * 6


def test_nested_archives(spark, tmp_path):
    good = child_zip("2026-01-15", [product(), product(id_producto="2")])
    children = [good, b"junk", child_zip("2026-01-13", [product()], leave_out="sucursales"), child_zip(None, [product()])]
    master_zip(tmp_path / "m.zip", children)
    found = archives.split_masters(archives.read_masters(spark, str(tmp_path)), "child_*.zip")
    states = {r.child[-5]: r.status for r in archives.child_status(found).collect()}
    assert states == {"0": "ok", "1": "malformed", "2": "malformed", "3": "ok"}

    rows = archives.table_rows(archives.member_lines(found), "productos")
    assert {(r.child[-5], r.id_producto) for r in rows.collect()} == {("0", "100"), ("0", "2"), ("3", "100")}

    merchant_lines = archives.member_lines(found, ("comercio",), complete_only=False)
    dated = freshness.child_dates(archives.child_status(found), merchant_lines)
    assert {r.child[-5]: r.fecha_pie for r in dated.collect()} == {
        "0": date(2026, 1, 15),
        "1": None,
        "2": date(2026, 1, 13),
        "3": None,
    }
    counts = freshness.package_completeness(dated.withColumn("target_date", F.lit(date(2026, 1, 15)))).head()
    assert counts[1:] == (4, 2, 2, 0, 3)


def test_a_broken_master_is_one_malformed_child(spark, tmp_path):
    (tmp_path / "m.zip").write_bytes(b"not an archive")
    found = archives.split_masters(archives.read_masters(spark, str(tmp_path)))
    assert [r.status for r in archives.child_status(found).collect()] == ["malformed"]


def vote(spark, ages):
    target = date(2026, 1, 15)
    rows = [("p", i, None if a is None else date.fromordinal(target.toordinal() - a), target) for i, a in enumerate(ages)]
    df = spark.createDataFrame(rows, "package string, ordinal int, fecha_pie date, target_date date")
    return freshness.package_vote(df).head()


@pytest.mark.parametrize(
    "ages, accepted",
    [
        ([0, 0, 0], True),
        ([2, 2, 2, 0, 0], False),
        ([1, 1, 2], True),
        ([2, 0], True),
        ([None, None], True),
        ([2, None], False),
        ([0] * 20 + [5] * 50, False),
        ([5] * 20 + [0] * 50, True),
        ([-1], True),
    ],
)
def test_freshness_vote(spark, ages, accepted):
    row = vote(spark, ages)
    assert row.accepted is accepted
    assert row.valid + row.stale + row.unknown == len(ages)


PORTAL = """
<html><head><title>Precios</title></head><body><p>Archivos del dia</p>
  <section><div class="row pkg-container"><div class="package-info"><h3>Lunes</h3><p> Actualizado: 2031-05-09 </p></div>
    <div class="pkg-actions"><a class="b" href="/ayuda">Ayuda</a><a href="datos/lunes_2031.zip">Bajar</a></div></div></section>
  <div class="pkg-container"><div class="package-info"><p>Actualizado: 2031-05-10<br></p><p>2030-12-31</p></div>
    <div class="pkg-actions"><a href="/ver">Ver</a><a href="/DOWNLOAD/2">Bajar</a></div></div>
  <div class="pkg-container"><div class="package-info"><p>Actualizado: 2031-05-11</p></div>
    <a href="/go/3"><b>DESCARGAR</b></a></div>
  <div class="pkg-container"><div class="package-info"><p>sin fecha</p></div><a href="/x.zip">DESCARGAR</a></div>
  <footer><a href="manual.zip?v=2">Manual</a></footer>
</body></html>"""


def test_portal_pages(spark):
    frame = spark.createDataFrame([(1, PORTAL), (2, "<p>nada</p>"), (3, None)], "page_id bigint, html string")
    links = pages.package_links(frame)
    assert [tuple(r) for r in links.orderBy("posicion").collect()] == [
        (1, 0, "2031-05-09", "datos/lunes_2031.zip"),
        (1, 1, "2031-05-10", "/DOWNLOAD/2"),
        (1, 2, "2031-05-11", "/go/3"),
    ]
    assert pages.link_for_day(links, "2031-05-09").collect() == [(1, "datos/lunes_2031.zip")]
    assert pages.link_for_day(links, "2031-06-01").isEmpty()
    assert sorted(r.href for r in pages.page_links(frame).collect()) == [
        "/DOWNLOAD/2",
        "/x.zip",
        "datos/lunes_2031.zip",
        "manual.zip?v=2",
    ]


def test_merged_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, DATE'2026-01-01' AS d").write.partitionBy("d").parquet(path)
    spark.sql("SELECT 2 AS a, 'x' AS b, DATE'2026-01-02' AS d").write.mode("append").partitionBy("d").parquet(path)
    rows = tables.scan(spark, path).select("a", "b", "d").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None, date(2026, 1, 1)), (2, "x", date(2026, 1, 2))]
