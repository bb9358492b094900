"""The check data's own jobs: what they may send to the driver."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import queries
from checks.queries import master_archives
from gondola.operators import dims

SF = "/root/testdata/sf0.001"


def test_archive_lines_are_never_broadcast(spark):
    plan = master_archives(spark, SF)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join [s_suppkey" in x]
    assert joins and all("SortMergeJoin" in x for x in joins), plan


def test_a_newest_row_sorts_dealt_out_rows(spark, tmp_path):
    """One file of one row group with few keys is many tasks' work, not one task's sort."""
    path = str(tmp_path / "snapshots")
    rows = spark.range(40_000).select(
        (F.col("id") % 2).cast("string").alias("id_producto"),
        F.xxhash64("id").alias("n"),
        F.lit(date(2026, 1, 1)).alias("fecha_vigencia"),
    )
    rows.coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        found = dims.productos_current(spark.read.parquet(path))
        first = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    least = rows.groupBy("id_producto").agg(F.min("n").alias("n")).collect()
    assert {(r.id_producto, r.n) for r in first} == {(r.id_producto, r.n) for r in least}
    below = plan[plan.rindex("WindowGroupLimit") :]  # what the cut before the key's shuffle reads
    assert "Exchange hashpartitioning(_deal" in below and "REBALANCE" in below, plan


def test_store_queries_do_not_build_the_price_table(spark, monkeypatch):
    built = []
    given = queries.bind
    monkeypatch.setattr(queries, "_written", {})
    monkeypatch.setattr(queries, "bind", lambda s, sf, name: built.append(name) or given(s, sf, name))
    assert queries.store_type_unknown(spark, SF).count() and queries.semi_stores(spark, SF).count()
    assert sorted(built) == ["raw_comercio", "raw_sucursales"]


def test_commits_and_the_stream_take_price_rows_from_the_source(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    assert queries.bronze_commit(spark, SF).count() == 3 and not queries._written
    assert queries.QUERIES["stream_ingest"](spark, SF).count() == 7
    assert {name for _, _, name in queries._written} == {"bronze-comercio", "bronze-sucursales"}


def test_text_files_are_written_without_a_shuffle_of_the_price_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    given = queries.bind(spark, SF, "raw_productos").count()
    assert queries.align_by_name(spark, SF).count() == queries.raw_csv_clean(spark, SF).count() == given
    assert {name for _, _, name in queries._written} == {"raw-prices"}
    rows = queries._raw_prices(spark, SF)
    assert rows.count() == given and "commit=" not in rows.inputFiles()[0]


def test_a_replaced_day_takes_its_rows_from_the_source_once(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    bound, given = [], queries.bind
    monkeypatch.setattr(queries, "bind", lambda s, sf, name: bound.append(name) or given(s, sf, name))
    rows = queries.silver_day_replace(spark, SF)
    assert bound == ["precios"] and not queries._written
    price = lambda df: df.groupBy("fecha_vigencia").agg(F.count("*").alias("n"), F.round(F.sum("precio_lista"), 2).alias("s"))
    before, after = ({r.fecha_vigencia: r for r in price(df).collect()} for df in (given(spark, SF, "precios"), rows))
    assert before.keys() == after.keys()
    for day, r in before.items():
        assert after[day].n == r.n and abs(after[day].s - r.s - (r.n if day == date(1999, 1, 1) else 0)) < 0.1


def test_parts_are_broadcast_by_the_size_of_their_rows_not_of_their_file(spark, tmp_path):
    """A part table that packs well is small as a file; its rows would go through the driver."""
    for name in ("lineitem", "supplier", "nation"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    part = spark.read.parquet(f"{SF}/part.parquet")
    more = part.crossJoin(spark.range(1, 500).withColumnRenamed("id", "_i"))
    more = more.withColumn("p_partkey", F.col("p_partkey") + F.col("_i") * 1_000_000).drop("_i")
    part.unionByName(more).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = queries.bind(spark, str(tmp_path), "precios")
    found = rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = [x for x in plan.splitlines() if "Join [" in x and "partkey" in x]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0], plan
    assert sorted(found, key=str) == sorted(queries.bind(spark, SF, "precios").collect(), key=str)


def test_archives_are_packed_from_the_source_without_a_bronze_table(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    assert queries.archive_members(spark, SF).count() and {name for _, _, name in queries._written} == {"masters"}


def test_archives_packed_in_sets_of_suppliers_are_those_packed_at_once(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    monkeypatch.setattr(queries, "SLICE_LINES", 2500)
    given, build = [], queries.master_archives
    monkeypatch.setattr(queries, "master_archives", lambda *x: given.append(x[2:]) or build(*x))
    names = lambda df: sorted(r.path for r in df.select("path").collect())
    found, whole = queries._masters(spark, SF), build(spark, SF)
    assert given == [(part, len(given)) for part in range(len(given))] and len(given) > 1
    assert names(found) == names(whole)
    counted = lambda df: sorted(queries.archives.member_lines(queries.archives.split_masters(df)).groupBy("package", "child", "table").count().collect())  # noqa: E731,E501
    assert counted(found) == counted(whole)


def test_bronze_build_spreads_archives_not_their_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "_written", {})
    hints, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, name, *x: hints.append(name) or hint(df, name, *x))
    found = queries.bronze_build(spark, SF)
    lines = queries.archives.member_lines(queries._children(spark, SF), ("productos",))
    assert found.count() == lines.count() > 0
    assert "rebalance" not in hints
