"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str], few_keys: bool = False
) -> DataFrame:
    """One row per key: the newest, ties broken by every other column in order.

    The tie break makes the order total, so reruns and retried tasks keep the same
    row. ``row_number() = 1`` lets Spark cut each map partition to one row per key
    before the shuffle (WindowGroupLimit), so a key with many copies stays cheap. That cut sorts what a
    task holds, and a compressed file unpacks to much more than its size: rows are dealt out first, in partitions
    of the advisory size, by a hash of the key, or of the whole row where ``few_keys`` have very many rows each.
    """
    dealt = df.withColumn("_deal", F.xxhash64(*(df.columns if few_keys else keys))).hint("rebalance", F.col("_deal")).drop("_deal")
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in newest_by] + [F.col(c).asc_nulls_last() for c in rest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return dealt.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
