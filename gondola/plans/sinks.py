"""Table writers and the folder operations around them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.folders import Folder
from gondola.schema import DATE, RAW_TABLES
from gondola.sources import manifest
from gondola.sources.tables import DAY_PARTS, day_folder, with_day_parts

ROWS_PER_FILE = 2_000_000
SUCCESS = "_SUCCESS"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Cluster keys per table: files are sorted by them so readers can skip row groups.
CLUSTER_BY = {
    "precios": ("id_producto", "id_comercio"),
    "fct_price_quotes": ("id_producto", "id_comercio"),
    "mart_daily_price_summary": ("id_producto",),
    "mart_store_coverage": ("provincia",),
    "gold_price_timeseries": ("categoria_inferida", "provincia"),
    "gold_cross_price_elasticity": ("categoria_inferida",),
    "gold_price_hypothesis": ("categoria_inferida", "provincia"),
}


def date_folders(table: Folder) -> list[str]:
    """Dates of a partitioned table as text, from folder names."""
    prefix = f"{DATE}="
    return [name[len(prefix) :] for name in table.children() if name.startswith(prefix)]


def _sized(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Rows gathered per partition value and sorted for file skipping.

    ``rebalance`` lets adaptive execution split a value that holds much of the data and
    merge small ones, so files come out near the advisory size without fixing a count.
    """
    present = [c for c in cluster if c in df.columns]
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *present)


def replace_days(df: DataFrame, path: str, table: str = "", whole: bool = False) -> None:
    """Replaces exactly the dates in ``df``; running it twice leaves the same rows.

    ``whole`` replaces the table, so dates that vanished upstream go too.
    """
    (
        _sized(df, DATE, CLUSTER_BY.get(table, ()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("compression", "zstd")
        .partitionBy(DATE)
        .parquet(path)
    )


def fan_out(df: DataFrame, writers: Sequence[Callable[[DataFrame], None]]) -> None:
    """Several targets from one computation of the frame."""
    cached = df.persist()
    try:
        for write in writers:
            write(cached)
    finally:
        cached.unpersist()


# --- bronze -----------------------------------------------------------------


def bronze_path(root: str, table: str) -> str:
    return f"{root}/bronze/{table}"


def _day_names(table: Folder) -> list[str]:
    return [
        f"{y}/{m}/{d}"
        for y in table.children()
        if y.startswith("year=")
        for m in table.child(y).children()
        for d in table.child(y, m).children()
        if d.startswith("day=")
    ]


def _marker(spark: SparkSession, root: str, day: date | str) -> Folder:
    return Folder(spark, f"{root}/bronze/_committed").child(day if isinstance(day, str) else day_folder(day), SUCCESS)


def day_exists(spark: SparkSession, root: str, day: date, force: bool = False) -> bool:
    """True only for a committed day: marker and all three tables. ``force`` ignores it."""
    if force or not _marker(spark, root, day).exists():
        return False
    live = manifest.live(spark, f"{root}/bronze") or {}
    return all((t, day_folder(day)) in live for t in RAW_TABLES)


def _commit(spark: SparkSession, root: str, changes: manifest.Live) -> None:
    """Makes written folders live with one small write, and marks the days that have all tables."""
    live = manifest.commit(spark, f"{root}/bronze", changes)
    for day in sorted({day for _, day in changes}):
        if all((t, day) in live for t in RAW_TABLES):
            _marker(spark, root, day).touch()


def _discard(spark: SparkSession, root: str, commit: str) -> None:
    for table in RAW_TABLES:
        Folder(spark, f"{bronze_path(root, table)}/commit={commit}").delete()


def write_bronze_day(frames: dict[str, DataFrame], root: str, day: date) -> dict[str, int]:
    """All three tables of a day or nothing. Returns the rows written per table.

    Tables are written beside the live ones and become live together. A missing or empty table,
    or a failed write, leaves an earlier committed day as it was.
    """
    spark = next(iter(frames.values())).sparkSession
    commit, rows, done = uuid.uuid4().hex, {}, False
    try:
        for table, df in frames.items():
            target = f"{bronze_path(root, table)}/commit={commit}/{day_folder(day)}"
            df.hint("rebalance").write.option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "zstd").parquet(
                target
            )
            rows[table] = spark.read.schema(df.schema).parquet(target).count()
        if all(rows.get(t, 0) > 0 for t in RAW_TABLES):
            _commit(spark, root, {(t, day_folder(day)): commit for t in RAW_TABLES})
            done = True
    finally:
        if not done:
            _discard(spark, root, commit)
    return {t: rows.get(t, 0) for t in RAW_TABLES}


def write_bronze_range(frames: dict[str, DataFrame], root: str) -> None:
    """Many days at once: frames carry the date; each date in them is replaced, all or none.

    All tables of all days are written beside the live ones and become live in one step. A table without rows
    on a date keeps what it has there. A date whose three tables are present is marked as committed.
    """
    spark = next(iter(frames.values())).sparkSession
    commit, changes, done = uuid.uuid4().hex, {}, False
    try:
        for table, df in frames.items():
            target = Folder(spark, f"{bronze_path(root, table)}/commit={commit}")
            (
                with_day_parts(df)
                .drop(DATE)
                .hint("rebalance", *[F.col(c) for c in DAY_PARTS])
                .write.option("maxRecordsPerFile", ROWS_PER_FILE)
                .option("compression", "zstd")
                .partitionBy(*DAY_PARTS)
                .parquet(target.path)
            )
            changes |= {(table, day): commit for day in _day_names(target)}  # folder names of the written days only
        if changes:
            _commit(spark, root, changes)
            done = True
    finally:
        if not done:
            _discard(spark, root, commit)


def drop_days(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    """Empties dates of a table."""
    for day in days:
        Folder(spark, path).child(f"{DATE}={day.isoformat()}").delete()


# --- upsert -----------------------------------------------------------------


def upsert_frames(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the keys of the batch, plus the batch; null equals null.

    Rows whose key is not in the batch stay, also when they vanished upstream.
    """
    t, b = target.alias("t"), batch.select(*keys).distinct().alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}"))
    return t.join(b, same, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def files_with_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of ``target`` that hold a key of the batch. Reads the key columns only; one name per file."""
    t, b = target.select(*keys, F.col("_metadata.file_path").alias("_file")).alias("t"), batch.select(*keys).distinct().alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}"))
    return sorted(r[0] for r in t.join(b, same, "left_semi").select("_file").distinct().collect())


JOURNAL = "_pending"


def finish_pending(spark: SparkSession, path: str) -> None:
    """Carries out what an interrupted upsert had decided: new files in, replaced files out. Running it twice is safe."""
    journal = Folder(spark, f"{path}/{JOURNAL}")
    if not journal.exists():
        return
    lines = [line.split("\t") for line in journal.read_text().splitlines()]
    for action, source, target in lines:
        if action == "move" and (file := Folder(spark, source)).exists():
            file.move_to(Folder(spark, target))
    for action, source, _ in lines:
        if action == "delete":
            Folder(spark, source).delete()
    journal.delete()


def upsert(batch: DataFrame, path: str, keys: Sequence[str], table: str = "") -> None:
    """Upsert into a date-partitioned table that rewrites only the files that hold a key of the batch.

    The batch is written to staging first: it is computed once. Files of its dates that hold none of its keys
    stay as they are; the others are written anew without those keys, beside the batch. A small journal then names
    the files that come and go; once it is there the upsert is carried out, if need be by the next one.
    """
    spark = batch.sparkSession
    if not Folder(spark, path).exists():
        replace_days(batch, path, table)
        return
    finish_pending(spark, path)
    staging = Folder(spark, f"{path}/.staging-{uuid.uuid4().hex}")
    try:
        batch.write.partitionBy(DATE).parquet(staging.child("batch").path)
        staged = spark.read.schema(batch.schema).parquet(staging.child("batch").path)
        # One value per date of the batch, read from folder names: literals prune the target.
        names = date_folders(staging.child("batch"))
        if NO_DATE in names:
            raise ValueError(f"rows of the batch have no {DATE}")
        days = [date.fromisoformat(d) for d in names]
        target = spark.read.schema(batch.schema).parquet(path).filter(F.col(DATE).isin(days))
        hit = files_with_keys(target, staged, keys) if days else []
        rows = staged
        if hit:
            held = spark.read.schema(batch.schema).option("basePath", path).parquet(*map(_plain, hit))
            rows = upsert_frames(held, staged, keys)
        new = staging.child("new")
        replace_days(rows, new.path, table)
        moves = [
            ("move", new.child(folder, file).path, f"{path}/{folder}/{file}")
            for folder in new.children()
            if folder.startswith(f"{DATE}=")
            for file in new.child(folder).children()
            if file[0] not in "._"
        ]
        lines = moves + [("delete", _plain(file), "") for file in hit]
        if lines:
            Folder(spark, f"{path}/{JOURNAL}").write_text("".join("\t".join(x) + "\n" for x in lines))
            finish_pending(spark, path)
    finally:
        if not Folder(spark, f"{path}/{JOURNAL}").exists():
            staging.delete()


def _plain(uri: str) -> str:
    """A file address without its escapes."""
    return unquote(uri)


def compact_days(spark: SparkSession, path: str, schema: T.StructType, table: str = "", most_files: int = 8) -> list[str]:
    """Rewrites the dates that many upserts have left in more than ``most_files`` files; returns those dates."""
    finish_pending(spark, path)
    folder = Folder(spark, path)
    names = [d for d in date_folders(folder) if d != NO_DATE]
    many = [d for d in names if sum(f[0] not in "._" for f in folder.child(f"{DATE}={d}").children()) > most_files]
    if many:
        rows = spark.read.schema(schema).parquet(path).filter(F.col(DATE).isin([date.fromisoformat(d) for d in many]))
        replace_days(rows, path, table)
    return many


# --- retention --------------------------------------------------------------


def retention_plan(table: DataFrame, as_of: date, keep_days: int) -> DataFrame:
    """Rows per date and whether the date is past retention."""
    cutoff = F.lit((as_of - timedelta(days=keep_days)).isoformat()).cast("date")
    counts = table.groupBy(DATE).agg(F.count("*").alias("filas"))
    return counts.withColumn("borrar", F.col(DATE) < cutoff)


def drop_old_days(spark: SparkSession, path: str, as_of: date, keep_days: int) -> list[str]:
    """Removes date folders older than the retention; returns the dates removed."""
    cutoff = as_of - timedelta(days=keep_days)
    dropped = [d for d in date_folders(Folder(spark, path)) if date.fromisoformat(d) < cutoff]
    drop_days(spark, path, [date.fromisoformat(d) for d in dropped])
    return dropped
