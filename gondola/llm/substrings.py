"""Repeated passages: substring dedup with prefix-partitioned suffix trees.

A word is removed if it lies in a window of ``window`` words that also starts earlier (smaller doc_id, or
same document and earlier start). Windows are the suffixes of all documents cut at that depth; two
windows are equal when their suffixes meet in an internal node at least that deep. The tree is never
built as a whole: it is split by prefix, and each level meets only where the level above has branches.

Documents whose whole text also has a smaller id are settled first, by grouping on the text's hash: all their
windows start earlier. The others go down the tree:

* *Prefix level.* A suffix's prefix ends with the least-hash gram of ``GRAM`` words of its window, so
  prefixes have between GRAM and ``window`` words, and equal windows have equal ones. Suffixes that
  share that gram (an anchor) are one entry; anchors are about one in eight positions. An anchor that
  occurs once has no branch below it, and its suffixes go no further.
* *Deep level.* The suffixes of anchors that are left are grouped by all ``window`` words: a group with two
  leaves is a deep internal node, its first leaf stays, the others are repeats. Runs of repeats
  are the maximal repeats' later occurrences; a document gets them as position ranges.

Groups are runs of a sorted partition and never larger than the number of batches read: what occurs
several times in one batch is settled there, and only its first occurrence (or one witness) is sent to
the group's task. So a passage that a third of all documents share costs a row per batch.

Edge cases: null and empty texts have no words; documents shorter than the window lose nothing; a null id
counts as the smallest; repeated rows (same id and text) start equally early, so neither covers the
other; several texts under one id are told apart by their hash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import Spans, column_bytes, only, shipped, whole_runs, without, written

WINDOW = 20
GRAM = 6
_LOW = np.uint64(0xFFFFFFFF)
_FIRST = -(2**63)  # where a null id stands in the order


def anchors(spans: Spans, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams, and for each window the position of its least gram."""
    grams = spans.of(GRAM)
    span = window - GRAM + 1
    if len(grams) < span:
        return grams, np.zeros(0, np.int64)
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    return grams, (least & _LOW).astype(np.int64)


def _batch(names: tuple[str, ...], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(names))


def _rows_of(texts: list[bytes], keys: np.ndarray, window: int) -> Iterator[tuple[int, Spans]]:
    """Row numbers and spans of the texts of a batch that have a window, each document once."""
    seen = set()
    for i, text in enumerate(texts):
        if keys[i] not in seen:
            words = text.split()
            if len(words) >= window:
                seen.add(keys[i])
                yield i, Spans(words)


def _ascending(h: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    return np.lexsort((*ties[::-1], h))


def live_anchors(docs: DataFrame, window: int) -> DataFrame:
    """d and pos of the anchors whose gram occurs twice or more in the corpus."""
    names = ("part", "d", "pos", "state")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("d").to_numpy()
            gram, d, pos = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, spans in _rows_of(column_bytes(batch), keys, window):
                grams, at = anchors(spans, window)
                at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                gram.append(grams[at])
                d.append(np.full(len(at), keys[i]))
                pos.append(at)
            gram, d, pos = np.concatenate(gram).view(np.int64), np.concatenate(d), np.concatenate(pos)
            order = np.argsort(gram, kind="stable")
            gram, d, pos = gram[order], d[order], pos[order]
            same = np.concatenate(([False], gram[1:] == gram[:-1], [False]))[: len(gram) + 1]
            known = same[1:] | same[:-1]
            first = known & ~same[:-1]
            # Known rows go anywhere (state 1); one witness (state 2) tells the other batches.
            yield _batch(
                names,
                np.concatenate((np.where(known, d + pos * 0x9E3779B1, gram), gram[first])),
                np.concatenate((d, d[first])),
                np.concatenate((pos, pos[first])).astype(np.int32),
                np.concatenate((known.astype(np.int32), np.full(first.sum(), 2, np.int32))),
            )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, d, pos, state, starts in whole_runs(batches, names):
            ends = np.append(starts[1:], len(part))
            met = np.add.reduceat(state != 1, starts) > 1
            met |= np.add.reduceat(state == 2, starts) > 0
            take = (state == 1) | ((state == 0) & np.repeat(met, ends - starts))
            yield _batch(("d", "pos"), d[take], pos[take])

    rows = shipped(docs).select("d", "text").mapInArrow(emit, "part long, d long, pos int, state int")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(keep, "d long, pos int")


def repeats(docs: DataFrame, live: DataFrame, window: int) -> DataFrame:
    """d and pos of every window that also starts earlier. ``live`` has the anchors of each d in ``at``."""
    names = ("part", "ord", "pos", "d", "known")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("d").to_numpy()
            order_by = [_FIRST if x is None else x for x in batch.column("doc_id").to_pylist()]
            at = batch.column("at")
            none = np.zeros(0, np.int64)
            h, o, p, d = [none.view(np.uint64)], [none], [none], [none]
            for i, spans in _rows_of(column_bytes(batch), keys, window):
                _, of = anchors(spans, window)
                is_live = np.zeros(spans.n, bool)
                is_live[at[i].values.to_numpy()] = True
                pos = np.flatnonzero(is_live[of])
                h.append(spans.between(pos, pos + window - 1))
                o.append(np.full(len(pos), order_by[i]))
                p.append(pos)
                d.append(np.full(len(pos), keys[i]))
            h, o, p, d = np.concatenate(h).view(np.int64), np.concatenate(o), np.concatenate(p), np.concatenate(d)
            by = _ascending(h, o, p)
            h, o, p, d = h[by], o[by], p[by], d[by]
            known = _later(h, o, p)
            yield _batch(names, np.where(known, d + p * 0x9E3779B1, h), o, p.astype(np.int32), d, known)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, o, p, d, known, _ in whole_runs(batches, names):
            take = known.copy()
            rest = np.flatnonzero(~known)
            take[rest] = _later(part[rest], o[rest], p[rest])
            yield _batch(("d", "pos"), d[take], p[take])

    schema = "part long, ord long, pos int, d long, known boolean"
    rows = shipped(docs.join(live, "d")).select("d", "doc_id", "text", "at").mapInArrow(emit, schema)
    return rows.repartition("part").sortWithinPartitions("part", "ord", "pos").mapInArrow(keep, "d long, pos int")


def _later(h: np.ndarray, o: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether a row, sorted by hash, order and position, has a strictly earlier one of its hash."""
    if not len(h):
        return np.zeros(0, bool)
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    first = np.repeat(start, np.diff(np.append(start, len(h))))
    return (o != o[first]) | (p != p[first])


def _positions(rows: DataFrame) -> DataFrame:
    """One row per document; a group has at most as many rows as the document has words."""
    return rows.groupBy("d").agg(F.collect_list("pos").alias("at"))


def later_copies(keyed: DataFrame) -> DataFrame:
    """d of the documents whose text a document with a smaller id has, too."""
    same = ("h1", "h2")
    rows = keyed.where("text is not null").select(
        "d", F.coalesce("doc_id", F.lit(_FIRST)).alias("ord"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")
    )
    first = rows.groupBy(*same).agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last").drop("last")
    return rows.join(first, list(same)).where("ord > first").select("d").distinct()


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words a window covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return np.cumsum(step)[:n] > 0


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words that stay, joined by a space), kept_sha256 and ranges
    (first word and end of each removed range) of every row."""
    if not GRAM <= window:
        raise ValueError(f"windows have at least {GRAM} words")
    # No alias where none is needed: it would keep the two reads of the exchange below apart.
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("d"), "doc_id", "text")
    copies = written(later_copies(keyed), "substring-copies")
    # The documents are dealt by their hash once: both joins with them read the same columns.
    rest = without(keyed, copies, "d")
    found = _positions(repeats(rest, _positions(live_anchors(rest, window)), window))
    whole = only(keyed, copies, "d").withColumn("at", F.lit(None).cast("array<int>")).withColumn("whole", F.lit(True))
    rows = rest.join(found, "d", "left").withColumn("whole", F.lit(False)).unionByName(whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, whole = batch.column("at"), batch.column("whole").to_pylist()
            total, removed, kept, sha, ranges = [], [], [], [], []
            for i, text in enumerate(column_bytes(batch)):
                words = text.split()
                spans = []
                if whole[i] and len(words) >= window:
                    words_left, spans = [], [[0, len(words)]]
                elif at[i].is_valid:
                    gone = covered(len(words), at[i].values.to_numpy().astype(np.int64), window)
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    spans = edge.reshape(-1, 2).tolist()
                    left = [words[a:b] for a, b in zip([0, *edge[1::2]], [*edge[::2], len(words)])]
                    words_left = [w for part in left for w in part]
                else:
                    words_left = words
                joined = b" ".join(words_left)
                total.append(len(words))
                removed.append(len(words) - len(words_left))
                kept.append(joined)
                sha.append(hashlib.sha256(joined).hexdigest())
                ranges.append(spans)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(sha, pa.string()),
                    pa.array(ranges, pa.list_(pa.list_(pa.int32()))),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256", "ranges"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, ranges array<array<int>>"
    return shipped(rows).select("doc_id", "text", "at", "whole").mapInArrow(cut, schema)
