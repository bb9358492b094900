"""Document quality by pairwise ranking.

A linear score is learned from preference pairs, a document of label 1 over one of label 0, by
the Bradley-Terry model: logistic loss on the difference of the two documents' features. Features are
hashed words (log counts, length 1) and a few shares: symbols, digits, capitals, repeated words and
lines, lengths. The decision threshold is the quantile of the training scores at the share of label 0;
a logistic curve maps it to ``CUT``.

The fit uses every labelled document. They are dealt to blocks of about ``BLOCK`` by a hash of the id; a task fits
a block on ``PAIRS`` pairs in which each of its documents occurs, and the weights are the blocks' mean, by their
documents. A block that holds one class only has no pairs. The threshold is an exact quantile of all their
scores, found by counting in two steps. Scoring reads every whole text in place, without a shuffle.

Edge cases: null text is empty and scored; labels that are null or have no document are left out; without
both classes every score is 0.5; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import Spans, column_bytes, shipped, written

DIMS = 1024
BLOCK = 5000
PAIRS = 40_000
CUT = 0.3
_BYTES = np.zeros((256, 6), np.float32)  # letter, capital, digit, space, line feed, symbol
for _c in range(256):
    _kind = 0 if 97 <= _c <= 122 or _c >= 128 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else None
    _kind = _kind if _kind is not None else 4 if _c == 10 else 3 if _c in (9, 11, 12, 13, 32) else 5
    _BYTES[_c, _kind] = 1
STATS = 14


def features(text: bytes) -> np.ndarray:
    """DIMS hashed words, then STATS shares."""
    words = text.lower().split()
    x = np.zeros(DIMS + STATS, np.float32)
    if words:
        h = Spans(words).of(1)
        tf = np.log1p(np.bincount((h % np.uint64(DIMS)).astype(np.int64), minlength=DIMS).astype(np.float32))
        x[:DIMS] = 3 * tf / np.linalg.norm(tf)
        n, total = len(words), len(text)
        kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float32) @ _BYTES / total
        lines = [s for s in text.split(b"\n") if s]
        lengths = np.fromiter(map(len, words), np.float32, n)
        ordered = np.sort(h)
        runs = np.diff(np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))))
        x[DIMS:] = (
            *(3 * kinds),
            len(runs) / n,
            runs.max() / n,
            len(set(lines)) / max(1, len(lines)),
            np.log1p(n) / 5,
            lengths.mean() / 8,
            lengths.std() / 8,
            np.log1p(len(lines)) / 3,
            sum(w[-1:] in b".!?" for w in words) / n,
        )
    return x


def _placed(docs: DataFrame, known: DataFrame, learn: Column, blocks: int) -> DataFrame:
    """Texts and labels in one sorted stream a block: a document's labels come just before its texts. One shuffle."""
    texts = docs.where(learn & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), "text", F.lit(None).cast("int").alias("quality")
    )
    rows = texts.unionByName(known.select("doc_id", F.lit(None).cast("string").alias("text"), "quality"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    placed = rows.withColumn("block", block).repartitionById(blocks, F.col("block"))  # a block a task
    return placed.sortWithinPartitions("block", "doc_id", F.col("quality").isNull())


LEARNED = "quality int, x binary, w binary, n long"


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of every labelled document, and one row with the weights of each block."""
    schema = pa.schema([("quality", pa.int32()), ("x", pa.binary()), ("w", pa.binary()), ("n", pa.int64())])

    def fitted(rows: list[tuple[bytes, int]]) -> pa.RecordBatch:
        rows.sort()
        x = [r[0] for r in rows]
        good = np.array([r[1] == 1 for r in rows], bool)
        both = 0 < good.sum() < len(good)
        w = [rank(np.frombuffer(b"".join(x), np.float32).reshape(len(x), -1), good).tobytes()] if both else []
        none, n = [None] * len(x), len(w)
        columns = ([r[1] for r in rows] + [None] * n, x + [None] * n, none + w, none + [len(x)] * n)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    now, block, held, rows = None, None, [], []
    for batch in batches:
        ids, blocks, labels = (batch.column(c).to_pylist() for c in ("doc_id", "block", "quality"))
        for i, text in enumerate(column_bytes(batch)):
            if blocks[i] != block:
                if rows:
                    yield fitted(rows)
                block, rows = blocks[i], []
            if ids[i] != now:
                now, held = ids[i], []
            if labels[i] is not None:
                held.append(labels[i])
            elif held:
                x = features(text).tobytes()
                rows += [(x, label) for label in held]
    if rows:
        yield fitted(rows)


def _kth(keys: DataFrame, k: int) -> int:
    """The k-th smallest (from 1) of 32-bit integers: by the upper half's counts, then by the lower half's."""

    def step(part: DataFrame, by: Column, k: int) -> tuple[int, int]:
        for value, n in sorted(tuple(r) for r in part.groupBy(by.alias("v")).count().collect()):  # at most 65,536 rows
            if k <= n:
                return value, k
            k -= n
        raise ValueError("fewer values than k")

    upper = F.shiftright("key", 16)
    high, k = step(keys, upper, k)
    return step(keys.where(upper == high), F.col("key"), k)[0]


def rank(x: np.ndarray, good: np.ndarray, ridge: float = 1e-3, rounds: int = 400, seed: int = 7) -> np.ndarray:
    """Weights that make documents of label 1 score above those of label 0: gradient steps with momentum."""
    rng = np.random.default_rng(seed)
    up, down = (rng.permutation(np.resize(rng.permutation(np.flatnonzero(c)), PAIRS)) for c in (good, ~good))
    scale = x.std(axis=0) + 1e-3
    z = (x / scale).astype(np.float32)
    z[:, :DIMS] = x[:, :DIMS] * 4
    w, m, v = np.zeros(x.shape[1], np.float32), 0.0, 0.0
    for t in range(1, rounds + 1):
        s = z @ w
        miss = 1 / (1 + np.exp(np.clip(s[up] - s[down], -30, 30)))  # probability of the wrong order
        push = np.bincount(up, miss, len(z)) - np.bincount(down, miss, len(z))
        g = -(push.astype(np.float32) @ z) / PAIRS + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    out = w / scale
    out[:DIMS] = w[:DIMS] * 4
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[np.ndarray, float, float] | None:
    """Weights, the score at the cut, and the slope of the curve; None without both classes."""
    known = labels.where(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).distinct()
    blocks = max(1, -(-known.count() // BLOCK))
    learned = written(shipped(_placed(docs, known, learn, blocks)).mapInArrow(_learned, LEARNED), "quality")
    fits = learned.where("w IS NOT NULL").select("w", "n").collect()  # one row a block
    if not fits:
        return None
    total = sum(r.n for r in fits)
    parts = sorted((bytes(r.w), r.n) for r in fits)
    w = sum(np.frombuffer(x, np.float32).astype(np.float64) * (n / total) for x, n in parts).astype(np.float32)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([np.frombuffer(x, np.float32) @ w for x in batch.column("x").to_pylist()], np.float32).view(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(s < 0, s ^ 0x7FFFFFFF, s))], ["key"])  # in the scores' order

    scores = written(learned.where("x IS NOT NULL").select("x").mapInArrow(keys, "key int"), "quality-scores")
    key = _kth(scores, learned.where("quality = 0").count())
    cut = np.array(key if key >= 0 else key ^ 0x7FFFFFFF, np.int32).view(np.float32)
    return w, float(cut), 1.0


def score(docs: DataFrame, model: tuple[np.ndarray, float, float] | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score at least CUT) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMS + STATS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = column_bytes(batch)
            if model is None:
                out = np.full(len(texts), 0.5)
            else:
                w, cut, slope = model
                s = np.array([features(t) @ w for t in texts], np.float64)
                out = 1 / (1 + np.exp(-np.clip(slope * (s - cut) + np.log(CUT / (1 - CUT)), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    rows = shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
