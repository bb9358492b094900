"""Helpers the operators share: written tables, texts of Arrow batches, span hashes, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.session import scratch_dir, ship_package

WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and read back
    after the loss of any executor."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, with this package importable in the Python workers."""
    ship_package(df.sparkSession)
    return df


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows in what is written inside: bounds the memory of Python workers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


SMALL = 1 << 20


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is not in ``ids``, with the same choice of join as ``only``."""
    return only(df, ids, key, "left_anti")


def only(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose key is in ``ids`` (distinct, one column). The ids are counted: up to SMALL of
    them are broadcast, so the wide rows stay where they are; more are joined by a shuffle."""
    ids = written(ids, "ids")
    return df.join(F.broadcast(ids) if ids.count() <= SMALL else ids, key, how)


def whole_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of rows sorted by the first, cut between its values only, and the start of each run.

    Holds the rows of one run at a time besides a batch.
    """
    held: list[list[np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
        key = columns[0]
        if last is not None and key[-1] == last:
            held.append(columns)
            continue
        cut = int(np.searchsorted(key, key[-1]))
        held.append([c[:cut] for c in columns])
        yield from _with_starts(held)
        held, last = [[c[cut:] for c in columns]], key[-1]
    yield from _with_starts(held)


def _with_starts(held: list[list[np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    columns = [np.concatenate(c) for c in zip(*held)]
    if columns and len(key := columns[0]):
        yield (*columns, np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))))


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def column_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 texts of a batch; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


# Span hashes: each byte has a random 64-bit value, a span is their polynomial in an odd
# base modulo 2**64, mixed at the end. Prefix sums give any span's hash in constant time.
_RNG = np.random.Generator(np.random.PCG64(20_240_601))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grow(n: int) -> None:
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Spans:
    """Hashes of word spans of one text: words joined by one space."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        joined = b" ".join(words)
        raw = np.frombuffer(joined, np.uint8)
        _grow(len(raw) + 1)
        gaps = np.flatnonzero(raw == 32)
        self.starts = np.concatenate(([0], gaps + 1)) if self.n else np.zeros(0, np.int64)
        self.ends = np.concatenate((gaps, [len(raw)])) if self.n else np.zeros(0, np.int64)
        self._prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _powers["up"][: len(raw)], out=self._prefix[1:])

    def of(self, k: int) -> np.ndarray:
        """Hashes of all spans of k words."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        s, e = self.starts[: self.n - k + 1], self.ends[k - 1 :]
        return mixed((self._prefix[e] - self._prefix[s]) * _powers["down"][s] + (e - s).astype(np.uint64))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the spans from word first to word last, inclusive."""
        s, e = self.starts[first], self.ends[last]
        return mixed((self._prefix[e] - self._prefix[s]) * _powers["down"][s] + (e - s).astype(np.uint64))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(h) < 2:
        return h
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components by alternating large and small stars.

    ``edges`` has longs a and b. Returns node, component (its smallest node), one row for each
    node that has an edge. Every round is aggregates and joins, written to the shared folder; a
    node with very many neighbours is a partial minimum and a skew join, never one group.
    """
    now = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), purpose
    )
    state = None
    while True:
        both = now.union(now.select("m", "v"))
        least = both.groupBy("v").agg(F.min("m").alias("least"))
        large = (
            both.join(least, "v")
            .where("m > v")
            .select(F.col("m").alias("v"), F.least("least", "v").alias("m"))
            .where("v != m")
            .distinct()
        )
        small_least = large.groupBy("v").agg(F.min("m").alias("least"))
        small = (
            large.join(small_least, "v")
            .select(F.explode(F.array("v", "m")).alias("v"), F.col("least").alias("m"))
            .where("v != m")
            .distinct()
        )
        now = written(small, purpose)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.groupBy(F.col("v").alias("node")).agg(F.min("m").alias("component")).unionByName(
        now.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    )
