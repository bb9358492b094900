"""Benchmark decontamination by edit distance.

Texts are compared in lower case with runs of white space as one space. An item of n characters
matches a passage with at most ``error_rate * n`` edits (insertions, deletions, substitutions). Any such
passage holds one of ``errors + 1`` pieces of the item unchanged, by the pigeonhole principle: the
pieces are found by one Aho-Corasick pass over the whole text, and each hit is verified with Myers'
bit-parallel distance on the part of the text around it, hits whose parts overlap together.

Items travel to the tasks in blocks of bounded size (``block_bytes``): a larger benchmark makes more
passes, not larger broadcasts. Documents are read in place; nothing is shuffled.

Edge cases: null and empty documents and items match nothing; items without a character after
normalising are left out, items shorter than a piece must occur unchanged; items with equal text match
alike, each under its own id; repeated rows are searched each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import shipped

ERROR_RATE = 0.08
LEAST_PIECE = 8
BLOCK_BYTES = 1 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 consecutive pieces of the item, as even as they can be, with their offsets."""
    n = len(item)
    cuts = [n * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def budget(item: str, error_rate: float = ERROR_RATE) -> int:
    """Edits allowed: the rate's share, but pieces keep LEAST_PIECE characters."""
    return max(0, min(int(error_rate * len(item)), len(item) // LEAST_PIECE - 1))


class Pattern:
    """An item prepared for Myers' algorithm: bits of each character's positions."""

    def __init__(self, item: str, errors: int):
        self.n, self.errors = len(item), errors
        self.bits: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.bits[c] |= 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """The least distance between the item and any passage of the text, and the passage's end."""
        n, get = self.n, self.bits.get
        mask, high = (1 << n) - 1, 1 << (n - 1)
        up, down, score = mask, 0, n
        least, end = n, 0
        for i, c in enumerate(text):
            eq = get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            rise, fall = down | ~(xh | up) & mask, up & xh
            if rise & high:
                score += 1
            elif fall & high:
                score -= 1
            rise, fall = (rise << 1) & mask, (fall << 1) & mask
            up, down = fall | ~(xv | rise) & mask, rise & xv
            if score < least:
                least, end = score, i + 1
        return least, end


class Finder:
    """All items of a block, with one automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.patterns = []
        self.same: dict[str, list[int]] = defaultdict(list)
        for key, text in items:
            if text := normal(text):
                self.same[text].append(key)
        where = defaultdict(list)
        for text in self.same:
            errors = budget(text, error_rate)
            for offset, piece in pieces(text, errors):
                where[piece].append((len(self.patterns), offset, len(piece)))
            self.patterns.append((Pattern(text, errors), self.same[text]))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, uses)
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, passage end in the normalised text) of each item that the text holds."""
        if not self.patterns:
            return []
        parts: dict[int, list[list[int]]] = {}
        for last, uses in self.automaton.iter(text):
            for p, offset, length in uses:
                pattern = self.patterns[p][0]
                start = last + 1 - length - offset
                a, b = max(0, start - pattern.errors), min(len(text), start + pattern.n + pattern.errors)
                spans = parts.setdefault(p, [])
                if spans and a <= spans[-1][1] and b >= spans[-1][0]:
                    spans[-1] = [min(a, spans[-1][0]), max(b, spans[-1][1])]
                else:
                    spans.append([a, b])
        found = []
        for p, spans in parts.items():
            pattern, keys = self.patterns[p]
            best = min((*pattern.best(text[a:b]), a) for a, b in spans)
            if best[0] <= pattern.errors:
                found += [(key, best[0], best[2] + best[1]) for key in keys]
        return found


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``block_bytes`` characters (one item at least)."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text")).where("text is not null and item_id is not null")
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def matches(
    docs: DataFrame, benchmark: DataFrame, *, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, distance and end (of the passage in the normalised text) of each pair that matches."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, end long"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast((block, error_rate))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            finder = Finder(*sent.value)
            for batch in batches:
                rows = [
                    (doc_id, *hit)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    if text
                    for hit in finder.find(normal(text))
                ]
                columns = list(zip(*rows)) or [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "distance", "end"]
                )

        out = out.unionByName(shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema))
    return out


def without_matches(
    docs: DataFrame, benchmark: DataFrame, *, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of docs, all columns, that hold no item. Rows are filtered where they are read."""
    spark = docs.sparkSession
    columns = docs.columns
    out = docs
    for block in blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast((block, error_rate))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            finder = Finder(*sent.value)
            for batch in batches:
                clean = [not (t and finder.find(normal(t))) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_())).select(columns)

        out = shipped(out).mapInArrow(run, docs.schema)
    return out
