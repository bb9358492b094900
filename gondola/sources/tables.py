"""Parquet tables of the lake."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.schema import DATE, raw_schema
from gondola.sources.manifest import live_paths


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All live files of a table, united by column name, with partition columns.

    With a schema nothing is inferred; without one the footers of all files are merged.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


DAY_PARTS = ("year", "month", "day")


def with_day_parts(df: DataFrame) -> DataFrame:
    """Adds year, month and day text columns for a Hive layout with zero-padded values."""
    day = F.col(DATE)
    return df.withColumns(
        {
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
            "day": F.date_format(day, "dd"),
        }
    )


def day_folder(day: date) -> str:
    return f"year={day:%Y}/month={day:%m}/day={day:%d}"


def read_bronze(
    spark: SparkSession, path: str, table: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Bronze table in year=/month=/day= layout with its date restored: the live folders of its manifest, or all
    of the path where there is none.

    ``first`` and ``last`` leave out folders before they are listed. Filter on year, month and day to prune.
    """
    schema = raw_schema(table)
    for part in DAY_PARTS:
        schema = schema.add(part, T.StringType())
    bounds = day_folder(first) if first else "", day_folder(last) if last else "~"
    live = live_paths(spark, path, *bounds)
    if live is None:
        df = spark.read.schema(schema).parquet(path)
    elif live:
        df = spark.read.schema(schema.add("commit", T.StringType())).option("basePath", path).parquet(*live).drop("commit")
    else:
        df = spark.createDataFrame([], schema)
    day = F.concat_ws("-", *DAY_PARTS).cast("date")
    return df.withColumn(DATE, day)
