"""Near-duplicate documents: exact n-gram Jaccard self-join with signature trees.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (ASCII letters in lower case).
Two documents link when 100 * intersection >= 75 * union. Documents with equal sets are one class
(keyed by a 64-bit hash of the set and its size); everything below works on classes.

1. *Leaders.* Each class offers the least hash of each of ``BINS`` residues; classes that share one are
   compared with the smallest of them only. This joins most copies, however many, with one
   comparison each and only partial aggregates on the shared hash.
2. *Prefixes.* In any fixed order of shingles, linked sets share one of their first
   ``n - ceil(0.75 n) + 1``. Very frequent shingles come last in the order, the rest by hash. What comes
   before the first shared shingle is not shared, so its position bounds the size of a partner (the
   row's reach). Prefix shingles that no other class has are dropped right after one shuffle; shingles
   whose classes are all of one component already need no work, as a further link would change nothing.
3. *Hubs.* Twice, the classes of a live shingle are compared with one hub of it in another component: first
   the class whose shingle stands earliest for its size, which has the fewest shingles of its own before
   it, then one by hash. A cloud of near copies becomes one component this way, by one
   comparison for each class and hub.
4. *Signature trees.* The classes of a shingle that is left hang in trees: leaves are bitmaps of the
   sets, inner nodes hold OR-combined bitmaps, size ranges, the largest reach and the largest number of
   tokens that fell on a bit already set. Two trees are walked together; a node pair is dropped if its sizes are too
   far apart, if all of it is one component, or if ``common bits + doubled tokens`` is under the overlap
   that its sizes need. A shingle with very many classes is dealt to blocks, each pair of blocks a task.
5. *Check.* Pairs that survive are compared exactly, on the shingle sets of their texts.

A row's component is the smallest doc_id of its component. No step drops, caps or samples pairs.

Edge cases: null and empty texts have an empty set and link with nothing; fewer than five words are one
shingle; rows with a null id link like others, but are a component's id only where all its ids are null;
repeated rows are in one class, rows of one id with different texts in a class each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import SMALL, Spans, batches_of, column_bytes, components, distinct, only, shipped, whole_runs, written

SHINGLE = 5
BINS = 8
HEAVY = 1 << 16
HEAVY_IN_BATCH = 8
BLOCK = 4096
FANOUT = 16
BATCH = 2000  # rows sent to a Python worker at a time
_NONE = np.zeros(0, np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.lower().split()
    if not words:
        return _NONE
    spans = Spans(words)
    return distinct(spans.of(min(SHINGLE, spans.n)))


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def class_key(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes(), len(h)) >> 1


def bitmap(h: np.ndarray) -> np.ndarray:
    """Between 2 and 4 bits per token, as a power of two of at least 64 bits."""
    size = max(64, 1 << (2 * len(h) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(h >> np.uint64(32)) & np.uint64(size - 1)] = 1
    return np.packbits(bits)


def prefix(h: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The first shingles in the order (heavy, hash), as many as the overlap leaves free, plus one."""
    k = len(h) - (3 * len(h) + 3) // 4 + 1
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
        late = heavy[at] == h
        h = np.concatenate((h[~late], h[late]))
    return h[:k]


def reach(n: int, k: int) -> np.ndarray:
    """For each of the first k shingles, the largest set that can link if it is the first shared one."""
    return (4 * n - 7 * np.arange(k)) // 3


def _arrow(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "longs": pa.list_(pa.int64())}
    names, types = zip(*(x.split(":") for x in schema.split()))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def profile(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, k (hash of the text), d (class), n, mins, bits. Rows with null d are frequent
    shingles: hash in ``mins``, documents of its batch in ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = batch.column(0).to_pylist(), [shingles(t) for t in column_bytes(batch)]
            mins, seen = [], {}
            for h in sets:
                low = (h & np.uint64(BINS - 1)).astype(np.int64)
                first = np.unique(low, return_index=True)[1]
                mins.append(h[first].view(np.int64))
            keys = [class_key(h) if len(h) else None for h in sets]
            for key, h in zip(keys, sets):
                seen.setdefault(key, h)
            pool = np.sort(np.concatenate(list(seen.values()) or [_NONE]))
            edge = np.flatnonzero(np.concatenate(([True], pool[1:] != pool[:-1], [True])))[: len(pool) + 1]
            counts = np.diff(edge) if len(pool) else np.zeros(0, np.int64)
            often = np.flatnonzero(counts >= HEAVY_IN_BATCH)
            heavy = pool[edge[often]].view(np.int64)
            yield _arrow(
                "doc_id:long k:long d:long n:int mins:longs bits:binary",
                ids + [None] * len(often),
                batch.column("k").to_pylist() + [None] * len(often),
                [k if k is not None else -1 for k in keys] + [None] * len(often),
                [len(h) for h in sets] + counts[often].tolist(),
                mins + [[x] for x in heavy],
                [bitmap(h).tobytes() if len(h) else b"" for h in sets] + [None] * len(often),
            )

    rows = shipped(docs).select(F.col("doc_id").cast("long"), "text", _text_key().alias("k"))
    return rows.mapInArrow(run, "doc_id long, k long, d long, n int, mins array<long>, bits binary")


def live_prefixes(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """token, d, reach: prefix shingles that two classes have at least.

    A shingle that several classes of one batch have is known to be live there: its rows skip the
    meeting of the shingle's rows, which one witness per batch joins. So a frequent shingle sends a
    row per batch to one task, not a row per document.
    """
    sent = docs.sparkSession.sparkContext.broadcast(heavy)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = sent.value
        for batch in batches:
            sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for text in column_bytes(batch):
                h = shingles(text)
                if len(h) and (key := class_key(h)) not in sets:
                    first = prefix(h, heavy)
                    sets[key] = first, reach(len(h), len(first))
            token = np.concatenate([h for h, _ in sets.values()] or [_NONE])
            far = np.concatenate([r for _, r in sets.values()] or [np.zeros(0, np.int64)])
            d = np.repeat(np.fromiter(sets, np.int64, len(sets)), [len(h) for h, _ in sets.values()])
            order = np.argsort(token, kind="stable")
            token, d, far = token[order].view(np.int64), d[order], far[order]
            same = np.concatenate(([False], token[1:] == token[:-1], [False]))
            known = same[1:] | same[:-1]
            first = known & ~same[:-1]  # the witness of a run
            part = np.where(known, d ^ np.roll(token, 1), token)
            yield _arrow(
                "part:long token:long d:long reach:int state:int",
                np.concatenate((part, token[first])),
                np.concatenate((np.where(known, token, 0), token[first] * 0)),
                np.concatenate((d, d[first])),
                np.concatenate((far, far[first])).astype(np.int32),
                np.concatenate((known.astype(np.int32), np.full(first.sum(), 2, np.int32))),
            )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, token, d, far, state, starts in whole_runs(batches, ("part", "token", "d", "reach", "state")):
            ends = np.append(starts[1:], len(part))
            open_ = state != 1
            witness = np.add.reduceat(state == 2, starts) > 0
            big, small = np.where(open_, d, -1), np.where(open_, d, np.iinfo(np.int64).max)
            several = np.maximum.reduceat(big, starts) > np.minimum.reduceat(small, starts)
            live = np.repeat(witness | several, ends - starts)
            take = (state == 1) | (live & (state == 0))
            yield _arrow("token:long d:long reach:int", np.where(state == 1, token, part)[take], d[take], far[take])

    schema = "part long, token long, d long, reach int, state int"
    rows = shipped(docs).select(F.lit(0).alias("doc_id"), "text").mapInArrow(emit, schema)
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(keep, "token long, d long, reach int")


class Tree:
    """A signature tree over sets with bitmaps of one width, rows in the given order."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, c: np.ndarray, far: np.ndarray, rows: np.ndarray):
        extra = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.rows = rows
        self.levels = [(bits, n, n, extra, c, c, far)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, extra, c_low, c_high, far = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(extra, at),
                    np.minimum.reduceat(c_low, at),
                    np.maximum.reduceat(c_high, at),
                    np.maximum.reduceat(far, at),
                )
            )


def _possible(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether some pair below nodes i and j can link, and would join two components."""
    low_x, high_x, extra_x, c_low_x, c_high_x, far_x = (a[i] for a in x[1:])
    low_y, high_y, extra_y, c_low_y, c_high_y, far_y = (a[j] for a in y[1:])
    ok = (4 * high_x >= 3 * low_y) & (4 * high_y >= 3 * low_x) & (far_x >= low_y) & (far_y >= low_x)
    ok &= (c_low_x != c_high_y) | (c_low_y != c_high_x)
    at = np.flatnonzero(ok)  # bitmaps last: they cost most
    i, j, low_x, low_y = i[at], j[at], low_x[at], low_y[at]
    bits_x, bits_y = x[0][i], y[0][j]
    most = np.bitwise_count(bits_x & bits_y).sum(axis=1, dtype=np.int64) + np.minimum(extra_x[at], extra_y[at])
    most = np.minimum(most, np.minimum(high_x[at], high_y[at]))
    ok[at] = 7 * most >= 3 * (low_x + low_y)
    return ok


def dual(a: Tree, b: Tree, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two trees (or of one, each once) that no bound excludes."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(la, lb, i, j)]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > 1 << 14:  # bounds the memory of a step
            half = len(i) // 2
            stack += [(la, lb, i[:half], j[:half]), (la, lb, i[half:], j[half:])]
            continue
        ok = _possible(a.levels[la], b.levels[lb], i, j)
        if same and la == lb:
            ok &= i <= j if la else i < j
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            out.append((a.rows[i], b.rows[j]))
            continue
        step = np.arange(FANOUT)
        down_a, down_b = la >= lb, lb >= la
        if down_a:
            i, j = (i[:, None] * FANOUT + step).ravel(), np.repeat(j, FANOUT)
            ok = i < len(a.levels[la - 1][0])
            i, j = i[ok], j[ok]
        if down_b:
            i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + step).ravel()
            ok = j < len(b.levels[lb - 1][0])
            i, j = i[ok], j[ok]
        stack.append((la - down_a, lb - down_b, i, j))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _folded(bits: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of a width or twice as wide, OR-folded to it."""
    out = np.zeros((len(bits), width), np.uint8)
    for row, b in zip(out, bits):
        raw = np.frombuffer(b, np.uint8)
        row[:] = raw if len(raw) == width else raw[:width] | raw[width:]
    return out


def tree_pairs(bits: list[bytes], n: np.ndarray, c: np.ndarray, far: np.ndarray, side: np.ndarray | None = None):
    """Index pairs that may link and have different c; with sides, only pairs across them.

    Bitmaps are powers of two wide: sizes that can link are of equal width or one step apart, so each
    width is joined with itself and, folded, with the next.
    """
    width = np.array([len(b) for b in bits])
    order = np.lexsort((n, c))
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def tree(w: int, at: int, s) -> Tree | None:
        rows = order[(width[order] == w) & ((side[order] == s) if side is not None else True)]
        return Tree(_folded([bits[r] for r in rows], at), n[rows], c[rows], far[rows], rows) if len(rows) else None

    for w in np.unique(width).tolist():
        for wide in (w, 2 * w):
            for s, t in [(None, None)] if side is None else [(0, 1)] if wide == w else [(0, 1), (1, 0)]:
                a, b = tree(w, w, s), tree(wide, w, t)
                if a and b:
                    pairs.append(dual(a, b, side is None and wide == w))
    return np.concatenate([p for p, _ in pairs]), np.concatenate([q for _, q in pairs])


def leaf_pairs(
    bits: list[bytes], n: np.ndarray, c: np.ndarray, far: np.ndarray, side: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What ``tree_pairs`` finds in each run of rows (starts to ends) of at most FANOUT rows: such a tree is one node,
    so the pairs of its leaves are held to the bounds for all runs at once. Rows of equal side are not paired, where
    side is not negative."""
    rows = _ranges(starts, ends - starts)
    later = np.repeat(ends, ends - starts) - 1 - rows
    i, j = np.repeat(rows, later), _ranges(rows + 1, later)
    ok = (c[i] != c[j]) & (4 * n[i] >= 3 * n[j]) & (4 * n[j] >= 3 * n[i]) & (far[i] >= n[j]) & (far[j] >= n[i])
    ok &= (side[i] < 0) | (side[i] != side[j])
    i, j = i[ok], j[ok]
    width = np.fromiter(map(len, bits), np.int64, len(bits))
    swap = width[i] > width[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    out = [(i[:0], j[:0])]
    for w in np.unique(width[i]).tolist():
        for wide in (w, 2 * w):
            at = np.flatnonzero((width[i] == w) & (width[j] == wide))
            sides = []
            for some in (i[at], j[at]):
                own, where = np.unique(some, return_inverse=True)
                folded = _folded([bits[r] for r in own], w).view(np.uint64)
                extra = n[own] - np.bitwise_count(folded).sum(axis=1, dtype=np.int64)
                sides.append((folded[where], extra[where], n[some]))
            (x, extra_x, n_x), (y, extra_y, n_y) = sides
            most = np.bitwise_count(x & y).sum(axis=1, dtype=np.int64) + np.minimum(extra_x, extra_y)
            at = at[7 * np.minimum(most, np.minimum(n_x, n_y)) >= 3 * (n_x + n_y)]
            out.append((i[at], j[at]))
    return np.concatenate([p for p, _ in out]), np.concatenate([q for _, q in out])


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of each pair, one after the other."""
    skip = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) if len(length) else length
    return skip + np.arange(len(skip))


def shingle_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """d and h (sorted shingle hashes, 8 bytes each) of the given classes (d, rep), one row each. Texts are
    found by the id of one of the class; a class whose ids are all null, among the rows without an id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = only(docs, classes.where("rep is not null").select(F.col("rep").alias("id")).distinct(), "id")
    if not classes.where("rep is null").isEmpty():
        texts = texts.unionByName(docs.where("id is null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [h for h in map(shingles, column_bytes(batch)) if len(h)]
            yield _arrow("d:long h:binary", [class_key(h) for h in sets], [h.tobytes() for h in sets])

    found = shipped(texts.select("text")).mapInArrow(run, "d long, h binary")
    # Rows of one id may be of other classes, and of the same one more than once.
    return found.join(classes.select("d"), "d", "left_semi").dropDuplicates(["d"])


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs a, b of classes whose documents link, by an exact comparison of their shingles."""
    pairs = written(pairs, "jaccard-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct().join(classes.select("d", "rep"), "d")
    sets = written(shingle_sets(docs, written(needed, "jaccard-needed")), "jaccard-sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, _NONE
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "h_a", "h_b")))):
                if a != last:
                    last, held = a, np.frombuffer(x, np.uint64)
                other = np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(held, other), len(held) - 1)
                both = int((held[at] == other).sum())
                keep[i] = 100 * both >= 75 * (len(held) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    rows = (
        pairs.join(sets.select(F.col("d").alias("b"), F.col("h").alias("h_b")), "b")
        .join(sets.select(F.col("d").alias("a"), F.col("h").alias("h_a")), "a")
        .select("a", "b", "h_a", "h_b")
    )
    return shipped(rows).mapInArrow(compare, "a long, b long").distinct()


def _leader_pairs(classes: DataFrame) -> DataFrame:
    """Each class with the smallest class that shares a least hash."""
    offers = classes.select("d", F.explode("mins").alias("m"))
    leaders = offers.groupBy("m").agg(F.min("d").alias("a"), F.max("d").alias("most")).where("a != most").drop("most")
    return offers.join(leaders, "m").where("d != a").select("a", F.col("d").alias("b")).distinct()


def _labelled(live: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
    """The live rows with the size n and the component c of their class."""
    named = classes.join(joined.select(F.col("node").alias("d"), "component"), "d", "left")
    return live.join(named.select("d", "n", F.coalesce("component", "d").alias("c")), "d")


def _hub_pairs(labelled: DataFrame, score) -> DataFrame:
    """Each class with the hub (largest score) of a shingle, where components differ and sizes and reaches allow it."""
    hub = F.max(F.struct(score.alias("score"), "d", "c", "n", "reach")).alias("hub")
    hubs = labelled.groupBy("token").agg(hub, F.min("c").alias("low"), F.max("c").alias("high")).where("low != high")
    fits = "c != hub.c and 4 * n >= 3 * hub.n and 4 * hub.n >= 3 * n and reach >= hub.n and hub.reach >= n"
    pairs = labelled.join(hubs.select("token", "hub"), "token").where(fits)
    return pairs.select(F.least("d", "hub.d").alias("a"), F.greatest("d", "hub.d").alias("b")).distinct()


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that the bitmaps' bound lets link."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, bits_a, bits_b = (batch.column(x).to_pylist() for x in ("a", "b", "bits_a", "bits_b"))
            n_a, n_b = (batch.column(x).to_numpy() for x in ("n_a", "n_b"))
            keep = []
            for i in range(len(a)):
                x, y = np.frombuffer(bits_a[i], np.uint8), np.frombuffer(bits_b[i], np.uint8)
                w = min(len(x), len(y))
                if max(len(x), len(y)) <= 2 * w:
                    x, y = (v if len(v) == w else v[:w] | v[w:] for v in (x, y))
                    ones = [int(np.bitwise_count(v).sum()) for v in (x, y, x & y)]
                    most = ones[2] + min(n_a[i] - ones[0], n_b[i] - ones[1])
                    if 7 * most >= 3 * (n_a[i] + n_b[i]):
                        keep.append(i)
            yield _arrow("a:long b:long", [a[i] for i in keep], [b[i] for i in keep])

    side = lambda x: classes.select(F.col("d").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").where("4 * n_a >= 3 * n_b and 4 * n_b >= 3 * n_a")
    return shipped(rows).mapInArrow(prune, "a long, b long")


def _crossing(labelled: DataFrame) -> DataFrame:
    """Labelled rows whose size some row of another component of the shingle reaches, where two components are left."""
    per_c = labelled.groupBy("token", "c").agg(F.max("reach").alias("far"))
    first = per_c.groupBy("token").agg(F.max(F.struct("far", "c")).alias("first"))
    second = per_c.join(first, "token").where("c != first.c").groupBy("token").agg(F.max("far").alias("second"))
    limits = first.join(second, "token")  # shingles of one component have no second
    within = F.col("n") <= F.when(F.col("c") == F.col("first.c"), F.col("second")).otherwise(F.col("first.far"))
    return labelled.join(limits, "token").where(within).select(labelled.columns)


def _bucket_pairs(labelled: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes of different components that share a live shingle and pass the trees."""
    labelled = written(_crossing(labelled), "jaccard-crossing")
    per_token = labelled.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("size"))
    mixed = per_token.where("low != high").select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = labelled.join(mixed, "token").distinct().join(classes.select("d", "bits"), "d")
    own = F.pmod(F.col("d"), F.col("blocks")).cast("int")
    # With several blocks a row goes to every pair of blocks that its own block is part of.
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(
        F.xxhash64("token", i, j).alias("part"), "d", "c", "n", "reach", "bits", (F.col("own") == j).cast("int").alias("side"),
        (i != j).cast("int").alias("across"),
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("part", "d", "c", "n", "reach", "bits", "side", "across")
        for _, d, c, n, far, bits, side, across, starts in whole_runs(batches, names):
            sizes, reaches, bits = n.astype(np.int64), far.astype(np.int64), bits.tolist()
            ends = np.append(starts[1:], len(d))
            few = ends - starts <= FANOUT
            facing = np.where(across == 1, side, -1)
            pairs = [leaf_pairs(bits, sizes, c, reaches, facing, starts[few], ends[few])]
            for s, e in zip(starts[~few], ends[~few]):
                p, q = tree_pairs(bits[s:e], sizes[s:e], c[s:e], reaches[s:e], side[s:e] if across[s] else None)
                pairs.append((s + p, s + q))
            found = [np.sort(np.stack((d[p], d[q]), axis=1), axis=1) for p, q in pairs]
            found = np.unique(np.concatenate(found), axis=0)  # shingles of one batch often give the same pair
            yield _arrow("a:long b:long", found[:, 0], found[:, 1])

    return shipped(rows.repartition("part").sortWithinPartitions("part")).mapInArrow(walk, "a long, b long").distinct()


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profile of every row, and of every class its component_id and the row that stands for its component
    (``first``: its id and text key, smallest id first, null ids last)."""
    docs = docs.select("doc_id", "text")
    rows = written(profile(docs), "jaccard-profile")
    sets = rows.where("d >= 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k")).alias("first")
    classes = written(
        sets.groupBy("d").agg(
            F.min("doc_id").alias("rep"), first, F.first("n").alias("n"), F.first("mins").alias("mins"), F.first("bits").alias("bits")
        ),
        "jaccard-classes",
    )
    frequent = rows.where("d is null").groupBy(F.col("mins")[0].alias("h")).agg(F.sum("n").alias("n"))
    top = [r.h for r in frequent.orderBy(F.desc("n"), "h").limit(HEAVY).collect()]  # a fixed bound
    heavy = np.sort(np.array(top, np.int64).view(np.uint64))

    links = written(verified(_bounded(_leader_pairs(classes), classes), classes, docs), "jaccard-links")
    live = written(live_prefixes(docs, heavy), "jaccard-live")
    early = F.col("reach") - F.col("n")
    for score in (early, F.when(early >= 0, F.xxhash64("token", "d"))):
        labelled = _labelled(live, classes, written(components(links), "jaccard-components"))
        found = verified(_bounded(_hub_pairs(labelled, score), classes), classes, docs)
        links = written(links.union(found), "jaccard-links")
    labelled = _labelled(live, classes, written(components(links), "jaccard-components"))
    found = written(verified(_bucket_pairs(labelled, classes), classes, docs), "jaccard-links")
    node = components(links.union(found))
    whole = (
        classes.join(node, classes.d == node.node, "left")
        .select("d", "first", F.coalesce("component", "d").alias("c"))
    )
    least = whole.groupBy("c").agg(F.min("first").alias("first"))
    named = whole.drop("first").join(least, "c").select("d", "first", F.col("first.doc_id").alias("component_id"))
    return rows.where("d is not null"), written(named, "jaccard-named")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    with batches_of(docs.sparkSession, BATCH):
        rows, named = _named(docs)
    return rows.join(named, "d", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that stand for their component: smallest id first, null ids last; of rows with
    equal id and text, one. Rows without words stand for themselves."""
    with batches_of(docs.sparkSession, BATCH):
        rows, named = _named(docs)
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k")))
    # Rows are told apart by id and text, so rows of one id with other texts are not touched.
    gone = rows.join(named, "d").where(other).select("doc_id", "k").distinct()
    repeated = rows.groupBy("doc_id", "k").count().where("count > 1").select("doc_id", "k")
    gone, repeated = (
        written(x.select(F.col("doc_id").alias("__id"), F.col("k").alias("__k")), f"jaccard-{name}")
        for x, name in ((gone, "gone"), (repeated, "repeated"))
    )

    def matched(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (_text_key() == F.col("__k"))
        return df.join(F.broadcast(ids) if ids.count() <= SMALL else ids, same, how)

    out = matched(docs, gone, "left_anti")
    if repeated.isEmpty():
        return out
    return matched(out, repeated, "left_anti").unionByName(
        matched(out, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    )
