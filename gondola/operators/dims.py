"""Current state of the snapshot dimensions: the newest snapshot row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gondola.operators.latest import latest_per_key
from gondola.schema import DATE, MERCHANT_KEYS, PRODUCT_KEYS, STORE_CURRENT_KEYS


def current(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest_per_key(snapshots, keys, [DATE], few_keys=True)


def comercios_current(snapshots: DataFrame) -> DataFrame:
    return current(snapshots, MERCHANT_KEYS)


def sucursales_current(snapshots: DataFrame, keys: Sequence[str] = STORE_CURRENT_KEYS) -> DataFrame:
    return current(snapshots, keys)


def productos_current(snapshots: DataFrame) -> DataFrame:
    return current(snapshots, PRODUCT_KEYS)
