"""Product codes for vectors: Lloyd's rounds over partition-local cover trees.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; each part position has its own
codebook. All arithmetic is on integers, so a rerun or another partitioning gives the same codes.

1. Each task packs its rows into blocks of bounded size. For each part position a block has a cover tree: a
   node covers the rows of an interval within its radius; its children are centres more than half that
   radius apart that cover the rows within half of it. Rows are kept in tree order with cumulative sums, so
   the sum of a subtree is a difference of two rows. Blocks are written once to the shared folder; no
   state lives in an executor.
2. A round sends the codebooks (``parts * entries`` short vectors) to the tasks. A node whose nearest
   entry is nearer to its centre than any other by more than twice its radius gives its whole subtree to it, by the
   triangle inequality (with a margin for the rounding of roots). Other nodes descend; rows of ambiguous
   leaves are compared exactly. Each task returns one sum a codebook cell; Spark adds them up.
3. A last walk writes codes and errors; errors per label are one aggregate joined back.

Distances are exact: in doubles while every intermediate value is an integer under 2**53, in Python
integers beyond. Entries equal to an earlier one are never nearest.

Edge cases: vectors that are null or hold null or non-finite components are dropped; the first codebook
goes by id, then by vector, null ids last, repeated rows as often as they occur; with fewer rows than entries
the codebook is shorter; a vector that is empty, cannot be cut into equal parts, or is not as long as the
first of the codebook keeps its row, with null code and error, and counts nowhere else (a label of only
such rows has null label_error); integers beyond 2**49 in
size count as 2**49, errors beyond a long as the largest long; null labels are one label; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import SMALL, shipped, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LEAF = 16
BLOCK_VALUES = 1 << 19
LARGEST = 1 << 49
_LONG = (1 << 63) - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v (array of longs) of the vectors that are kept."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    return vectors.where(x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(x, whole).alias("v")
    )


def exact(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry, without rounding: doubles or Python integers."""
    largest = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0)
    if 4 * largest * largest * max(1, points.shape[1]) < 1 << 53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p * p).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (p @ e.T)
    return np.stack([((points.astype(object) - e) ** 2).sum(axis=1) for e in entries.astype(object)], axis=1)


class CoverTree:
    """A cover tree over integer rows: nodes level by level, each an interval of the rows in tree order."""

    def __init__(self, points: np.ndarray):
        order = np.arange(len(points))
        x = points.astype(np.float64)
        start, end, centre = [0], [len(points)], [0]
        radius, child, children = [], [], []
        at = 0
        while at < len(start):
            s, e, c = start[at], end[at], centre[at]
            rows = order[s:e]
            near = ((x[rows] - x[c]) ** 2).sum(axis=1)
            widest = float(near.max())
            radius.append(np.sqrt(widest))
            child.append(len(start))
            if e - s <= LEAF or widest == 0:
                children.append(0)
            else:
                centres, owner = [c], np.zeros(e - s, np.int64)
                while (far := int(near.argmax())) >= 0 and near[far] > widest / 4:
                    centres.append(int(rows[far]))
                    d = ((x[rows] - x[rows[far]]) ** 2).sum(axis=1)
                    owner[d < near] = len(centres) - 1
                    near = np.minimum(near, d)
                order[s:e] = rows[np.argsort(owner, kind="stable")]
                edge = s + np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(centres)))))
                start += edge[:-1].tolist()
                end += edge[1:].tolist()
                centre += centres
                children.append(len(centres))
            at += 1
        self.order, self.points = order, points[order]
        self.start, self.end = np.array(start), np.array(end)
        self.centres = points[centre]
        # Roots are rounded, and so are squares of very large integers: the radius is taken a little wider.
        self.radius = np.array(radius) * (1 + 1e-9)
        self.child, self.children = np.array(child), np.array(children)

    def assigned(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Intervals of rows and the entry that is nearest to all of each; every row is in one."""
        first = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        entries = entries[first]
        nodes = np.zeros(1, np.int64)
        while len(nodes):
            squared = exact(self.centres[nodes], entries)
            best = squared.argmin(axis=1)
            d = np.sqrt(squared.astype(np.float64))
            nearest = d[np.arange(len(nodes)), best]
            d[np.arange(len(nodes)), best] = np.inf
            other, radius = d.min(axis=1), self.radius[nodes]
            margin = 1e-9 * (nearest + radius + 1)
            # A radius of 0 means equal rows: the exact comparison of one holds for all.
            settled = (radius == 0) | (other * (1 - 1e-9) > nearest + 2 * radius + margin)
            yield self.start[nodes[settled]], self.end[nodes[settled]], first[best[settled]]
            open_ = nodes[~settled]
            leaves = open_[self.children[open_] == 0]
            rows = _ranges(self.start[leaves], self.end[leaves] - self.start[leaves])
            if len(rows):
                yield rows, rows + 1, first[exact(self.points[rows], entries).argmin(axis=1)]
            inner = open_[self.children[open_] > 0]
            nodes = _ranges(self.child[inner], self.children[inner])

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every row, in the order the rows were given."""
        code = np.zeros(len(self.order), np.int64)
        for s, e, best in self.assigned(entries):
            code[self.order[_ranges(s, e - s)]] = np.repeat(best, e - s)
        points = np.empty_like(self.points)
        points[self.order] = self.points
        gap = points - entries[code]
        if gap.size and int(np.abs(gap).max()) ** 2 * gap.shape[1] > _LONG:
            gap = gap.astype(object)
        return code, (gap * gap).sum(axis=1)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of each pair, one after the other."""
    length = length.astype(np.int64)
    skip = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) if len(length) else length
    return skip + np.arange(len(skip))


_FIELDS = ("order", "points", "start", "end", "centres", "radius", "child", "children")


def _packed(trees: list[CoverTree]) -> bytes:
    out = io.BytesIO()
    arrays = {}
    for i, tree in enumerate(trees):
        for name in _FIELDS:
            a = getattr(tree, name)
            if a.dtype == np.int64 and (not a.size or np.abs(a).max() < 1 << 31):
                a = a.astype(np.int32)
            arrays[f"{i}.{name}"] = a
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes, parts: int) -> list[CoverTree]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as z:
        trees = []
        for i in range(parts):
            tree = CoverTree.__new__(CoverTree)
            for name in _FIELDS:
                a = z[f"{i}.{name}"]
                setattr(tree, name, a if a.dtype == np.float64 else a.astype(np.int64))
            trees.append(tree)
    return trees


def blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """One row per block: ids, numbers of the labels, and the trees of its part positions."""
    size = max(1, BLOCK_VALUES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column("vec_id") for b in held])
            labels = pa.concat_arrays([b.column("label") for b in held])
            flat = np.concatenate([b.column("v").flatten().to_numpy() for b in held]).reshape(-1, parts, width // parts)
            blob = _packed([CoverTree(flat[:, p]) for p in range(parts)])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, labels)]
            return pa.RecordBatch.from_arrays([*lists, pa.array([blob], pa.binary())], ["ids", "labels", "trees"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, size - sum(b.num_rows for b in held))
                held.append(batch.slice(0, take))
                batch = batch.slice(take)
                if sum(b.num_rows for b in held) == size:
                    yield block()
                    held = []
        if held:
            yield block()

    label = rows.schema["label"].dataType.simpleString()
    kept = shipped(rows.where(F.size("v") == width))
    return kept.mapInArrow(run, f"ids array<long>, labels array<{label}>, trees binary")


def next_codebooks(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, width of a part) after one round."""
    parts, entries, width = books.shape
    sent = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), object)
        for batch in batches:
            for blob in batch.column("trees").to_pylist():
                for p, tree in enumerate(_unpacked(blob, parts)):
                    sums = np.concatenate((tree.points, np.ones((len(tree.points), 1), np.int64)), axis=1)
                    sums = np.concatenate((np.zeros((1, width + 1), np.int64), np.cumsum(sums, axis=0)))
                    found = np.zeros((entries, width + 1), np.int64)
                    for s, e, best in tree.assigned(sent.value[p]):
                        np.add.at(found, best, sums[e] - sums[s])
                    total[p] += found.astype(object)
        flat = total.ravel()
        cells = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array([Decimal(int(flat[i])) for i in cells], pa.decimal128(38, 0))], ["cell", "total"]
        )

    cells = shipped(trees.select("trees")).mapInArrow(run, "cell long, total decimal(38,0)").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros(parts * entries * (width + 1), object)
    for row in cells.collect():  # parts * entries * (width + 1) numbers at most
        total[row.cell] = int(row.total)
    total = total.reshape(parts, entries, width + 1)
    out = books.copy()
    for p, e in zip(*np.nonzero(total[:, :, width])):
        out[p, e] = [x // total[p, e, width] for x in total[p, e, :width]]
    return out


def _coded(trees: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    sent = trees.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, blob in enumerate(batch.column("trees").to_pylist()):
                found = [tree.codes(book) for tree, book in zip(_unpacked(blob, parts), sent.value)]
                names = np.array([f"{c:02x}" for c in range(256)])
                code = ["".join(x) for x in zip(*(names[c].tolist() for c, _ in found))]
                error = [min(_LONG, int(x)) for x in sum(d.astype(object) for _, d in found)]
                ids, labels = (batch.column(x).slice(i, 1).flatten() for x in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return shipped(trees).mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def encode(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code and error of every kept row, and the final codebooks (parts, entries, width)."""
    rows = usable(vectors, id_col, vector_col, label_col, scale)
    label = rows.schema["label"].dataType.simpleString()
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    by_id: list[Column] = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = rows.where(fits).orderBy(*by_id).limit(1).collect()
    width = len(first[0].v) if first else 0
    odd = rows.where(~fits | (F.size("v") != width)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    if not first:
        return odd, np.zeros((parts, 0, 0), np.int64)
    start = rows.where(F.size("v") == width).orderBy(*by_id).limit(entries).collect()
    books = np.array([r.v for r in start], np.int64).reshape(-1, parts, width // parts).transpose(1, 0, 2)
    trees = written(blocks(rows, width, parts), "codes-trees")
    for _ in range(rounds):
        books = next_codebooks(trees, books)
    return _coded(trees, books, label).unionByName(odd), books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows with label_error: the error summed over the rows of equal label. The sums are counted: few labels
    are broadcast, so a label with most rows moves none; more are joined by a shuffle that splits hot labels."""
    coded = written(coded, "codes-rows")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(total > _LONG, _LONG).otherwise(total).cast("long").alias("label_error")
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(total), "codes-labels")
    few = sums.count() <= SMALL
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes in DuckDB: every part against every entry in each round."""
    nearest = f"""SELECT rid, p.part, p.x, min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.y)
            + list_inner_product(b.y, b.y))::BIGINT * {entries} + b.e) AS m
        FROM p JOIN {{b}} b ON b.part = p.part GROUP BY rid, p.part, p.x"""
    ctes = [
        f"""v AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
               list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS c
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT rid, k AS part, c[k * (len(c) // {parts}) + 1 : (k + 1) * (len(c) // {parts})] AS x FROM v, range({parts}) t(k))",
        f"b0 AS MATERIALIZED (SELECT part, rid - 1 AS e, x AS y FROM p WHERE rid <= {entries})",
    ]
    for r in range(rounds):
        ctes += [
            f"a{r} AS MATERIALIZED ({nearest.format(b=f'b{r}')})",
            f"""s{r} AS (SELECT part, m % {entries} AS e, i, sum(x[i]::BIGINT)::BIGINT AS s, count(*) AS n
        FROM (SELECT part, m, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY part, m % {entries}, i)""",
            f"""n{r} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i)::DOUBLE[] AS y FROM s{r} GROUP BY part, e)""",
            f"b{r + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(n.y, b.y) AS y FROM b{r} b LEFT JOIN n{r} n ON n.part = b.part AND n.e = b.e)",
        ]
    ctes += [
        f"f AS ({nearest.format(b=f'b{rounds}')})",
        f"""d AS (SELECT rid, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error
        FROM f GROUP BY rid)""",
        f"""h AS (SELECT sha256(string_agg(z, ',' ORDER BY part, e)) AS codebooks_sha256
        FROM (SELECT part, e, array_to_string(list_transform(y, lambda c: c::BIGINT), ',') AS z FROM b{rounds}))""",
    ]
    return (
        "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN d USING (rid), h"""
    )


ORACLE = _oracle()
