"""Nearest neighbours by cosine with a vantage-point tree per shard.

Vectors of length 1 have a metric, the chord ``sqrt(2 - 2 cos)``. Rows are packed into shards of bounded
size where they are read, without a shuffle; each shard builds a tree once and writes it: a node keeps a vantage
point and the median distance to it, near rows go inside, the rest outside, leaves are small matrices. Queries
are packed into blocks the same way, and every block meets every shard's tree in some task: nothing of either
passes through the driver. A side is skipped when the triangle inequality puts it beyond the query's k-th
distance so far divided by ``factor``: with factor 1 the search is exact, larger factors skip more. Matrix products
only pick the rows that may be among the k (within a margin for their rounding); those are scored by one fixed
order of summation, so equal vectors have equal scores whatever task they are in, and ties go by id. The
shards' lists are merged by rank.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows of another length than a query's for that query; fewer candidates than k give all of them; repeated ids are
rows of their own, none is a neighbour of its own id; a query id in several rows is searched once, with its
smallest vector; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import batches_of, shipped, written

SHARD_ROWS = 8192
BLOCK = 2048
FEW_BLOCKS = 8
LEAF = 128
MARGIN = 1e-9  # far more than a product of unit vectors is rounded by


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of doubles) of the vectors that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull() & finite)
        .where(F.exists("v", lambda x: x != 0))
    )


class Tree:
    """A vantage-point tree over vectors of one length, any of them not zero."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 0):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], scaled(vectors[order])
        self.norms = lengths(self.vectors)
        self.unit = self.vectors / self.norms[:, None]
        rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)), rng)

    def _build(self, rows: np.ndarray, rng: np.random.Generator):
        if len(rows) <= LEAF:
            return rows
        at = rng.integers(len(rows))
        point, rest = rows[at], np.delete(rows, at)
        d = chord(self.unit[rest] @ self.unit[point])
        radius = np.median(d)
        inside = d <= radius
        if inside.all():  # equal distances: no border between them
            return rows
        return point, radius, self._build(rest[inside], rng), self._build(rest[~inside], rng)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of up to k rows for each query, in no order; -1 where there is none."""
        queries = scaled(queries)
        norms = lengths(queries)
        unit = queries / norms[:, None]
        best = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), -1, np.int64)

        def offer(q: np.ndarray, rows: np.ndarray) -> None:
            rough = unit[q] @ self.unit[rows].T
            worst = best[q].min(axis=1)
            may = (rough >= worst[:, None] - MARGIN) & (own[q][:, None] != self.ids[rows][None, :])
            at, col = np.nonzero(may)
            if not len(at):
                return
            sims = np.full(rough.shape, -np.inf)
            pair, row = q[at], rows[col]
            sims[at, col] = (queries[pair] * self.vectors[row]).sum(axis=1) / (norms[pair] * self.norms[row])
            both = np.concatenate((best[q], sims), axis=1)
            names = np.concatenate((found[q], np.broadcast_to(rows, sims.shape)), axis=1)
            # Equal scores go by the smaller id.
            key_id = np.where(names >= 0, self.ids[np.maximum(names, 0)], np.iinfo(np.int64).max)
            take = np.lexsort((key_id, -both), axis=1)[:, :k]
            best[q], found[q] = np.take_along_axis(both, take, 1), np.take_along_axis(names, take, 1)

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if isinstance(node, np.ndarray):
                for start in range(0, len(node), LEAF):
                    for first in range(0, len(q), 256):
                        offer(q[first : first + 256], node[start : start + LEAF])
                return
            point, radius, inside, outside = node
            offer(q, np.array([point]))
            d = chord(unit[q] @ self.unit[point])

            def near(sel: np.ndarray, gap: np.ndarray) -> np.ndarray:
                worst = best[q[sel]].min(axis=1)
                reach = np.where(np.isfinite(worst), chord(worst), np.inf) / factor
                return q[sel][gap[sel] <= reach + 1e-7]  # a margin for the rounding of the roots

            first = d <= radius
            visit(inside, q[first])
            visit(outside, q[~first])
            visit(outside, near(first, radius - d))
            visit(inside, near(~first, d - radius))

        visit(self.root, np.arange(len(queries)))
        found[~np.isfinite(best)] = -1
        return found, best


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def scaled(v: np.ndarray) -> np.ndarray:
    """The vectors times a power of two each, so squares neither overflow nor vanish; exact."""
    return np.ascontiguousarray(np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True, initial=0.0))[1]))


def lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1))


def _packed(rows: DataFrame, size: int, build) -> DataFrame:
    """width and a blob for each run of at most ``size`` rows (id, v) of one width, packed where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def blob(width: int) -> pa.RecordBatch:
            ids, vectors = held.pop(width)
            data = pickle.dumps(build(np.array(ids, np.int64), np.array(vectors, np.float64)))
            return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([data], pa.binary())], ["width", "blob"])

        for batch in batches:
            v = batch.column("v")
            for i, row in enumerate(batch.column("id").to_pylist()):
                vector = v[i].values.to_numpy()
                ids, vectors = held.setdefault(len(vector), ([], []))
                ids.append(row)
                vectors.append(vector)
                if len(ids) == size:
                    yield blob(len(vector))
        for width in list(held):
            yield blob(width)

    return shipped(rows.select("id", "v")).mapInArrow(run, "width int, blob binary")


def search(
    queries: DataFrame, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 5, factor: float = 1.0, shard_rows: int = SHARD_ROWS, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query, never its own id."""
    trees = written(_packed(usable(vectors, id_col, vector_col), shard_rows, Tree), "neighbours-trees")
    asked = usable(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    blocks = written(_packed(asked, block, lambda ids, v: (ids, v)), "neighbours-queries")
    # The stated query set against all rows, block by block: a pair is one block and one shard. A few blocks go to
    # every shard's task; more are sent to as many buckets as there are shards.
    shards = max(1, trees.count())
    bucket = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    dealt = trees.select("width", F.col("blob").alias("tree"), bucket.alias("bucket")).repartition(shards, "bucket")
    asked = blocks.select("width", F.col("blob").alias("asked"))
    if blocks.count() <= FEW_BLOCKS:
        pairs = dealt.join(F.broadcast(asked), "width")
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("bucket")
        pairs = dealt.join(asked.select("*", every).hint("merge"), ["bucket", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, (ids, asked) = (pickle.loads(batch.column(c)[i].as_py()) for c in ("tree", "asked"))
                found, scores = tree.search(asked, ids, k, factor)
                at, col = np.nonzero(found >= 0)
                columns = [ids[at], tree.ids[found[at, col]], scores[at, col]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    with batches_of(vectors.sparkSession, 1):
        merged = written(shipped(pairs.select("tree", "asked")).mapInArrow(run, "query_id long, vec_id long, score double"), "neighbours-found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "score")).alias("score"))
    )
