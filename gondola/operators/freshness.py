"""How fresh and complete the packages of a day are."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions import footer_date, is_footer

# Fixed value: tolerated age in days.
TOLERANCE = timedelta(days=1)

FILES_OF_A_CHILD = ("comercio", "sucursales", "productos")


def child_dates(children: DataFrame, lines: DataFrame) -> DataFrame:
    """Date in the first footer line of each child that has a date; null when none has.

    ``children``: package, child, ordinal, ...; ``lines``: package, child, line_no, line
    of the merchant file.
    """
    dated = (
        lines.filter(is_footer(F.col("line")))
        .select("package", "child", "line_no", footer_date(F.col("line")).alias("_date"))
        .filter(F.col("_date").isNotNull())
        .groupBy("package", "child")
        .agg(F.min_by("_date", "line_no").alias("fecha_pie"))
    )
    return children.join(dated, ["package", "child"], "left")


def date_status(fecha_pie: Column, target: Column) -> Column:
    too_old = fecha_pie < F.date_sub(target, TOLERANCE.days)
    return F.when(fecha_pie.isNull(), "unknown").when(too_old, "stale").otherwise("valid")


def package_vote(children: DataFrame) -> DataFrame:
    """Verdict per package from all its children: refused when stale ones outnumber valid ones.

    ``children``: package, fecha_pie, target_date. Ties and packages whose children carry
    no date pass.
    """
    status = date_status(F.col("fecha_pie"), F.col("target_date"))
    return (
        children.groupBy("package")
        .agg(
            F.count_if(status == "valid").alias("valid"),
            F.count_if(status == "stale").alias("stale"),
            F.count_if(status == "unknown").alias("unknown"),
        )
        .withColumn("accepted", F.col("stale") <= F.col("valid"))
    )


def package_completeness(children: DataFrame) -> DataFrame:
    """Per package: children that parse, malformed ones, and stale or undated ones.

    ``children``: package, status ('ok' or why it failed), fecha_pie, target_date. A
    malformed child counts as unknown too.
    """
    ok = F.col("status") == "ok"
    dated = date_status(F.col("fecha_pie"), F.col("target_date"))
    return children.groupBy("package").agg(
        F.count("*").alias("children"),
        F.count_if(ok).alias("parsed"),
        F.count_if(~ok).alias("malformed"),
        F.count_if(ok & (dated == "stale")).alias("stale"),
        F.count_if(~ok | (dated == "unknown")).alias("unknown"),
    )
