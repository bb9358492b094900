"""Mixing sources to target weights by entropy balancing.

The mix gives each document a rate r (expected copies). Among all rates that meet the token
constraints ``sum(size * r) = target`` of every source, entropy balancing takes the one with the
least relative entropy to the corpus, measured in tokens. Its convex dual has one multiplier per
source and no other unknown; the rate is the exponential tilt ``exp(lambda)``. Newton steps on
the dual sum gradient and curvature over the corpus with partial aggregates; the multipliers
stay a table of one row per source. Everything is DataFrame expressions.

Rounding: a document gets ``floor(rate)`` copies, and one more if its hash lies under its
source's threshold. The threshold is found by three levels of hash histograms (4096 bins each),
so a source's taken words differ from its target by less than one document or so, no source is
ever sorted as a whole, and a rerun takes the same copies.

Edge cases: null text has size 0; a null source is a source, last in the order; sources without
words get target 0; documents of size 0 are taken 0 times; repeated rows are documents of their
own, with the same hash; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import WORD, written

CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
BITS = 12


def _measured(docs: DataFrame) -> DataFrame:
    """docs with size (words) and h__, the hash the rounding orders documents by."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumn("size", size).withColumn(
        "h__", F.shiftrightunsigned(F.xxhash64("doc_id", "source", "size"), 1)
    )


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and h__ of every document."""
    return _measured(docs.select("doc_id", "source", "text")).drop("text")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, target: shares by weight, none above cap times the source's size.

    One row per source enters the windows. In the order of cap over weight the capped sources
    come first; the level of the others is what the capped ones leave, by weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = per_source.withColumn(
        "w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1))
    ).withColumn("most", F.lit(cap) * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("most") / F.col("w")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (
        weighted.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("before", F.sum("most").over(by_ratio) - F.col("most"))
        .withColumn("w_rest", F.sum("w").over(everything) - F.sum("w").over(by_ratio) + F.col("w"))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("w_rest"))
        .withColumn("free", F.col("most") / F.col("w") > F.col("level"))
        .withColumn("at", F.min(F.when(F.col("free"), F.col("most") / F.col("w"))).over(everything))
        .withColumn("water", F.max(F.when(F.col("most") / F.col("w") == F.col("at"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("free"), F.col("water") * F.col("w")).otherwise(F.col("most"))
    return level.select("source", "source_size", target.alias("target"))


def balance(sizes: DataFrame, goals: DataFrame, tolerance: float = 1e-9, steps: int = 60) -> DataFrame:
    """goals with the multiplier of each source, by Newton steps on the dual.

    The dual of a source is ``sum(size) * exp(lambda) - lambda * target`` with the sum over its
    documents. A step is bounded, so far-off targets converge too.
    """
    cells = written(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    state = goals.withColumn("lambda", F.lit(0.0))
    for _ in range(steps):
        tokens = F.col("n") * F.col("size") * F.exp("lambda")
        sums = (
            cells.join(state.select(F.col("source").alias("s"), "lambda"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(F.sum(tokens).alias("gathered"))
            .withColumnRenamed("source", "s")
        )
        step = (F.col("target") - F.col("gathered")) / F.col("gathered")
        state = written(
            state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").select(
                *goals.columns,
                (F.col("lambda") + F.coalesce(F.greatest(F.lit(-5.0), F.least(F.lit(2.0), step)), F.lit(0.0))).alias(
                    "lambda"
                ),
                F.when(F.col("target") > 0, F.abs(F.col("gathered") / F.col("target") - 1)).alias("off"),
            ),
            "mix-state",
        )
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
        state = state.drop("off")
    return state.drop("off")


def _bin(level: int) -> Column:
    return F.shiftrightunsigned("h__", 63 - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1)


def _thresholds(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """rates with whole__ (copies of every document) and limit__: hashes under it get one copy more."""
    whole = F.floor(F.col("rate") + 1e-9)
    rates = rates.withColumn("whole__", whole).withColumn("rest", F.col("target") - F.col("whole__") * F.col("source_size"))
    left = rates.select(F.col("source").alias("s"), "rest", F.lit(0).cast("long").alias("prefix"))
    same = F.col("source").eqNullSafe(F.col("s"))
    for level in range(2):
        cells = (
            sizes.join(left, same)
            .where((F.shiftrightunsigned("h__", 63 - BITS * level) == F.col("prefix")) if level else F.lit(True))
            .groupBy("s", "rest", "prefix", _bin(level).alias("bin"))
            .agg(F.sum("size").alias("words"))
        )
        upto = F.sum("words").over(Window.partitionBy("s").orderBy("bin"))
        edge = (
            cells.withColumn("upto", upto)
            .where("upto >= rest")
            .groupBy("s")
            .agg(F.min_by(F.struct("rest", "prefix", "bin", "words", "upto"), "bin").alias("x"))
            .select("s", "x.*")
        )
        left = edge.select(
            "s",
            (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"),
            (F.shiftleft("prefix", BITS) + F.col("bin")).alias("prefix"),
        )
    last = (
        sizes.join(left, same)
        .where(F.shiftrightunsigned("h__", 63 - BITS * 2) == F.col("prefix"))
        .groupBy("s", "rest", "prefix", "h__")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(Window.partitionBy("s").orderBy("h__")))
        .where(F.col("upto") - F.col("words") / 2 <= F.col("rest"))
        .groupBy("s")
        .agg(F.max("h__").alias("h__"))
    )
    limit = left.join(last.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left").select(
        "s", F.coalesce(F.col("h__") + 1, F.shiftleft("prefix", 63 - BITS * 2)).alias("limit__")
    )
    everyone = F.lit(2**63 - 1)  # a source whose rest no bin reaches is short of it by rounding only
    return rates.join(limit, same, "left").select(
        *rates.columns, F.when(F.col("rest") <= 0, F.lit(0)).otherwise(F.coalesce("limit__", everyone)).alias("limit__")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every document."""
    sizes = written(sized(docs), "mix-sizes")
    return _taken(sizes, _plan(sizes, weights, cap)).select("doc_id", "source", *ADDED)


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The documents that the mix takes, all columns, with the columns of ADDED."""
    plan = _plan(written(sized(docs), "mix-sizes"), weights, cap)
    columns = [c for c in docs.columns if c not in ADDED]
    return _taken(_measured(docs.select(*columns)), plan).where("copies > 0").select(*columns, *ADDED)


ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def _plan(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    goals = written(targets(sizes, weights, cap), "mix-goals")
    rate = F.when(F.col("target") > 0, F.least(F.lit(cap), F.exp("lambda"))).otherwise(0.0)
    return written(_thresholds(sizes, balance(sizes, goals).withColumn("rate", rate)), "mix-plan")


def _taken(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.withColumnRenamed("source", "s__")
    copies = F.when(F.col("size") > 0, F.col("whole__") + (F.col("h__") < F.col("limit__")).cast("long")).otherwise(0)
    return (
        sizes.join(plan, F.col("source").eqNullSafe(F.col("s__")))
        .withColumn("copies", copies.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
