"""The daily load: archives to bronze, bronze to silver, one day or a range of days."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gondola.operators import audit, clean, integrity, silver
from gondola.operators.freshness import child_dates, package_completeness, package_vote
from gondola.plans.models import table_path
from gondola.plans.sinks import Folder, bronze_path, day_exists, drop_days, replace_days, write_bronze_day
from gondola.schema import AUDIT_BRONZE, DATE, MERCHANT_KEYS, RAW_TABLES, STORE_KEYS
from gondola.sources import archives
from gondola.sources.tables import DAY_PARTS, read_bronze


class StalePackage(ValueError):
    """Most dated children of a package are too old."""


def check_range(first: date, last: date) -> None:
    if first > last:
        raise ValueError(f"range starts after it ends: {first} > {last}")


def ingest_day(
    spark: SparkSession, master_path: str, root: str, day: date, force: bool = False, child_glob: str = "*.zip"
) -> DataFrame | None:
    """Master archive of one day to committed bronze tables; returns the bronze audit rows.

    A committed day is left alone unless forced. A package whose children are mostly
    stale is refused before anything is written.
    """
    if day_exists(spark, root, day, force):
        return None
    now = silver.run_time()
    masters = archives.read_masters(spark, master_path)
    # Compressed children are kept for the passes below; each pass unpacks one member only.
    children = archives.split_masters(masters, child_glob).persist()
    try:
        merchant = archives.member_lines(children, ("comercio",), complete_only=False)
        dated = child_dates(archives.child_status(children), merchant).withColumn("target_date", F.lit(day))
        if not package_vote(dated).filter(~F.col("accepted")).isEmpty():
            raise StalePackage(f"{master_path}: stale children outnumber valid ones for {day}")
        frames = {t: archives.table_rows(archives.member_lines(children, (t,)), t, keep=()) for t in RAW_TABLES}
        # What was read is counted on the frames as they are written, what was written on the files.
        seen = {t: Observation(f"lines-{t}-{uuid.uuid4().hex}") for t in RAW_TABLES}
        counting = {t: df.observe(seen[t], F.count(F.lit(1)).alias("n")) for t, df in frames.items()}
        written = write_bronze_day(counting, root, day)
        if not all(written.values()):
            return None
        packages = (
            package_completeness(dated)
            .agg(*[F.sum(c).alias(c) for c in ("malformed", "stale", "unknown")])
            .withColumn(DATE, F.lit(day))
        )
        bronze = {t: bronze_rows(spark, root, t, day, day).drop(*DAY_PARTS) for t in RAW_TABLES}
        rows = [(day, t, seen[t].get["n"], len(frames[t].columns)) for t in RAW_TABLES]
        read = spark.createDataFrame(rows, f"{DATE} date, table string, csv_row_count long, csv_column_count int")
        path = f"{root}/audit/bronze"
        found = audit.bronze_audit(read, audit.table_volume(bronze), packages, now, master_path, f"{root}/bronze")
        audit.append_audit(found, path)
    finally:
        children.unpersist()
    return audit.audit_latest(spark.read.schema(AUDIT_BRONZE).parquet(path), len(RAW_TABLES), day.isoformat())


def bronze_rows(spark: SparkSession, root: str, table: str, first: date, last: date) -> DataFrame:
    """Bronze rows of a date range; folders outside it are not listed."""
    df = read_bronze(spark, bronze_path(root, table), table, first, last)
    text = F.concat("year", "month", "day")
    return df.filter(text.between(f"{first:%Y%m%d}", f"{last:%Y%m%d}"))


def clean_stores(bronze: Mapping[str, DataFrame], comercios: DataFrame) -> DataFrame:
    """Clean stores of declared merchants; a date without any declared merchant keeps its stores."""
    return integrity.keep_matching(
        clean.clean_sucursales(bronze["sucursales"]), comercios, MERCHANT_KEYS, spare_uncovered=True
    )


def validated(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean dimensions and the tagged price rows of the dates in ``bronze``."""
    comercios = clean.clean_comercio(bronze["comercio"])
    sucursales = clean_stores(bronze, comercios)
    tagged = integrity.tag_orphans(
        clean.tag_productos(bronze["productos"]), sucursales, STORE_KEYS, spare_uncovered=True
    )
    return {"comercio": comercios, "sucursales": sucursales, "productos": tagged}


def _dates(df: DataFrame) -> set[date]:
    """Dates of a frame: one value per day."""
    return {row[0] for row in df.select(DATE).distinct().collect() if row[0] is not None}


def load_silver(
    bronze: Mapping[str, DataFrame], root: str, scraped_at: datetime | None = None, audit_rows: bool = True
) -> DataFrame:
    """Loads every date in ``bronze`` (frames carry the date) and returns the drop counters.

    All dates go through one job per table, keyed by date, so a backfill is as parallel
    as a day. Cleaning and joining happen once: clean dimensions and tagged prices are staged,
    and writes, counters and the product dimension read the stage. The dates of the load are
    those of any of its tables; a table loses the rows of a date for which it got none.
    """
    spark = bronze["productos"].sparkSession
    now = scraped_at or silver.run_time()
    days = sorted(set().union(*(_dates(df) for df in bronze.values())))
    stage = Folder(spark, f"{root}/.staging/{uuid.uuid4().hex}")

    def staged(name: str, df: DataFrame) -> DataFrame:
        path = stage.child(name).path
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def replace(table: str, rows: DataFrame, present: set[date], cluster: str = "") -> None:
        replace_days(rows, table_path(root, table), cluster)
        drop_days(spark, table_path(root, table), [d for d in days if d not in present])

    try:
        comercios = staged("comercio", clean.clean_comercio(bronze["comercio"]))
        sucursales = staged("sucursales", clean_stores(bronze, comercios))
        replace("dim_comercios", silver.to_silver_comercios(comercios), _dates(comercios))
        replace("dim_sucursales", silver.to_silver_sucursales(sucursales), _dates(sucursales))
        tagged = clean.tag_productos(bronze["productos"])
        tagged = staged("productos", integrity.tag_orphans(tagged, sucursales, STORE_KEYS, spare_uncovered=True))

        counted = audit.drop_stats(tagged)
        per_day = counted.collect()  # one row per date
        stats = spark.createDataFrame(per_day, counted.schema)
        loaded = {row[DATE] for row in per_day if row["silver_loaded"]}
        prices = silver.to_silver_precios(silver.stamp(clean.kept(tagged), scraped_at=now))
        replace("precios", prices, loaded, "precios")
        # Literals prune the fact just written.
        written = spark.read.schema(prices.schema).parquet(table_path(root, "precios")).filter(F.col(DATE).isin(days))
        replace("dim_productos", integrity.distinct_products(silver.to_silver_productos(written)), loaded)
        if audit_rows:
            audit.append_audit(audit.silver_audit(stats, now), f"{root}/audit/silver")
    finally:
        stage.delete()
    return stats


def load_days(
    spark: SparkSession,
    root: str,
    first: date,
    last: date,
    scraped_at: datetime | None = None,
    bronze_root: str | None = None,
) -> DataFrame:
    """Backfill of an inclusive date range from bronze (under ``root`` unless given)."""
    check_range(first, last)
    bronze = {t: bronze_rows(spark, bronze_root or root, t, first, last) for t in RAW_TABLES}
    return load_silver(bronze, root, scraped_at)
