"""Drop counters and audit rows of a load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gondola.operators.clean import ABSURD, MISSING, NOT_POSITIVE, ORPHAN, REJECT
from gondola.operators.silver import stamp
from gondola.schema import AUDIT_BRONZE, AUDIT_SILVER, DATE


def _counters() -> list[Column]:
    reject = F.col(REJECT)
    return [
        F.count_if(reject == MISSING).alias("validation_dropped"),
        F.count_if(reject == ORPHAN).alias("integrity_dropped"),
        F.count_if(reject == NOT_POSITIVE).alias("negative_price_count"),
        F.count_if(reject == ABSURD).alias("absurd_price_count"),
        F.count_if(reject.isNull()).alias("silver_loaded"),
    ]


def drop_stats(tagged: DataFrame) -> DataFrame:
    """Counters per business date of a tagged frame."""
    return tagged.groupBy(DATE).agg(*_counters())


def observe_drops(tagged: DataFrame, observation: Observation) -> DataFrame:
    """The same counters gathered while the frame is written, without a second pass."""
    return tagged.observe(observation, *_counters())


def _as(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def silver_audit(stats: DataFrame, ingested_at: datetime) -> DataFrame:
    """One row per business date."""
    # The audit table has no column of its own for absurd prices: they count as not valid.
    not_valid = F.col("validation_dropped") + F.col("absurd_price_count")
    rows = stats.withColumns({"table_type": F.lit("silver_precios"), "validation_dropped": not_valid})
    return _as(stamp(rows, scraped_at=ingested_at).withColumnRenamed("scraped_at", "ingested_at"), AUDIT_SILVER)


def table_volume(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per date and table of a bronze build."""
    out = None
    for table, df in frames.items():
        width = len([c for c in df.columns if c != DATE])
        counts = df.groupBy(DATE).agg(F.count("*").alias("csv_row_count"))
        counts = counts.select(
            DATE, F.lit(table).alias("table"), "csv_row_count", F.lit(width).alias("csv_column_count")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


def bronze_audit(
    volumes: DataFrame,
    written: DataFrame,
    packages: DataFrame,
    ingested_at: datetime,
    raw_path: str = "",
    bronze_path: str = "",
) -> DataFrame:
    """Three rows per date. ``volumes`` and ``written`` come from ``table_volume`` over what was
    read and what was written; ``packages`` has malformed, stale and unknown counts per date."""
    rows = (
        volumes.join(
            written.select(DATE, "table", F.col("csv_row_count").alias("parquet_row_count")),
            [DATE, "table"],
            "left",
        )
        .join(packages, DATE, "left")
        .select(
            DATE,
            F.concat(F.lit("bronze_"), "table").alias("table_type"),
            "csv_row_count",
            "csv_column_count",
            F.coalesce("parquet_row_count", F.lit(0)).alias("parquet_row_count"),
            F.lit(raw_path).alias("raw_zip_path"),
            F.concat(F.lit(bronze_path + "/"), "table").alias("parquet_path"),
            F.coalesce("malformed", F.lit(0)).alias("malformed_zips_count"),
            F.coalesce("stale", F.lit(0)).alias("stale_count"),
            F.coalesce("unknown", F.lit(0)).alias("unknown_count"),
        )
    )
    return _as(stamp(rows, scraped_at=ingested_at).withColumnRenamed("scraped_at", "ingested_at"), AUDIT_BRONZE)


def append_audit(rows: DataFrame, path: str) -> None:
    """Appends audit rows (a handful per date) as one file."""
    rows.coalesce(1).write.mode("append").parquet(path)


def audit_latest(audit: DataFrame, limit: int = 10, day: str | None = None) -> DataFrame:
    """Newest audit rows, optionally of one business date."""
    if day is not None:
        audit = audit.filter(F.col(DATE) == F.lit(day).cast("date"))
    newest = [F.col("ingested_at").desc_nulls_last(), F.col(DATE).desc_nulls_last(), F.col("table_type").asc()]
    return audit.orderBy(*newest).limit(limit)
