"""Price measures whose result does not depend on the order rows are added in.

Adding doubles gives different last bits for every partitioning. Prices are added as
decimals with twelve places instead: far more than any declared price has, and room for
1e26 in all. Values a decimal cannot hold (NaN, infinite) make the measure what plain
addition makes of them; they are never left out of the sum alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(25,12)"


def price_decimal(c: Column) -> Column:
    return c.try_cast(PRICE)


TIMES = "decimal(12,0)"  # how often a price occurs: a price times this still fits a decimal


def exact_sum(c: Column, times: Column | None = None) -> Column:
    """Sum of the prices, each ``times`` over (once if not given): exact where every price fits a decimal."""
    exact = price_decimal(c)
    one = (exact, c) if times is None else (exact * times.cast(TIMES), c * times)
    return F.when(F.count(exact) == F.count(c), F.sum(one[0]).cast("double")).otherwise(F.sum(one[1]))


def exact_avg(c: Column) -> Column:
    return exact_sum(c) / F.count(c)


def percent_change(base: Column, other: Column) -> Column:
    return (other - base) / base * 100
