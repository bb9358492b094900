"""Referential checks between merchants, stores and prices.

``scope`` names the column one load is separated by (the date). With ``spare_uncovered`` a
date whose reference side is empty is left alone: without any declared store, all prices
of that day stay; ``uncovered_dates`` counts where that applies. The dates the reference
covers are a short list (one per day) and enter the plan as literals, so the checked rows are
joined once, on the whole key. Join strategy is Spark's choice: the reference side is
broadcast only when its statistics put it under the threshold, and beyond that a hot store
is split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.clean import ORPHAN, REJECT
from gondola.operators.latest import latest_per_key
from gondola.schema import DATE


def orphan_keys(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` without a row in ``reference``."""
    return df.select(*keys).distinct().join(reference.select(*keys), list(keys), "left_anti")


def _covered(reference: DataFrame, scope: Sequence[str]) -> list:
    """Values of the scope column that the reference has: one per day, read once."""
    return [row[0] for row in reference.select(*scope).distinct().collect()]


def _with_orphan(
    df: DataFrame, reference: DataFrame, keys: Sequence[str], scope: Sequence[str], spare_uncovered: bool
) -> tuple[DataFrame, Column]:
    by = [*scope, *keys]
    hits = reference.select(*by).distinct().withColumn("_hit", F.lit(True))
    out, orphan = df.join(hits, by, "left"), F.col("_hit").isNull()
    if not spare_uncovered:
        return out, orphan
    if not scope:
        return out, orphan & F.lit(not reference.isEmpty())
    return out, orphan & F.coalesce(F.col(scope[0]).isin(_covered(reference, scope)), F.lit(False))


def uncovered_dates(df: DataFrame, reference: DataFrame, scope: Sequence[str] = (DATE,)) -> DataFrame:
    """Rows per scope of ``df`` that the reference has no row for at all."""
    return df.groupBy(*scope).agg(F.count("*").alias("filas")).join(reference.select(*scope).distinct(), list(scope), "left_anti")


def tag_orphans(
    tagged: DataFrame,
    reference: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = (DATE,),
    spare_uncovered: bool = False,
) -> DataFrame:
    """Marks good rows without a reference row as rejected for integrity."""
    out, orphan = _with_orphan(tagged, reference, keys, scope, spare_uncovered)
    reason = F.when(F.col(REJECT).isNull() & orphan, ORPHAN).otherwise(F.col(REJECT))
    return out.withColumn(REJECT, reason).select(*tagged.columns)


def keep_matching(
    df: DataFrame,
    reference: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = (DATE,),
    spare_uncovered: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose key exists in ``reference``."""
    if not spare_uncovered:
        by = [*scope, *keys]
        return df.join(reference.select(*by).distinct(), by, "left_semi").select(*df.columns)
    out, orphan = _with_orphan(df, reference, keys, scope, spare_uncovered)
    return out.filter(~orphan).select(*df.columns)


def distinct_products(productos: DataFrame, scope: Sequence[str] = (DATE,)) -> DataFrame:
    """One row per product and load: the first by a total order over all columns."""
    return latest_per_key(productos, [*scope, "id_producto"], [])
