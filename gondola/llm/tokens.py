"""Token counts by a public subword vocabulary, with a two-tier lookup of pre-token lengths.

A pre-token is a run of spaces with the word that follows, or a line feed with its word. No piece
of the vocabulary crosses such a border (checked when the model is loaded), so a text's token
count is the sum over its pre-tokens. Tier one is a table of the most frequent pre-tokens' lengths,
broadcast; its size is bounded by ``frequent`` entries of at most ``LONGEST`` characters. Tier two is
a cache in each worker, bounded by ``cache`` entries, filled by encoding what it misses. Counting
happens where the text is read: no pre-token and no text is shuffled.

The table's frequencies come from all documents: each task keeps a bounded summary of the heaviest
pre-tokens it saw, and the summaries are added up. The table only decides what is fast.

Edge cases: null is empty text, with 0 bytes and 0 tokens; repeated rows are counted each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import shipped

FREQUENT = 1 << 16
CACHE = 150_000
LONGEST = 48
SUMMARY = 20_000
_PIECES = re.compile(" +[^ \n]*|\n[^ \n]*|[^ \n]+")


def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    """The tokenizer. Raises ValueError if its pieces may cross pre-token borders."""
    tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = (tokenizer.id_to_piece(i) for i in range(tokenizer.vocab_size()))
    if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
        raise ValueError("a piece of the vocabulary crosses pre-token borders")
    return tokenizer


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without the space that joins them: words, " " before further spaces, and line
    feeds with the word after them."""
    text = text.replace("▁", " ").replace("\n", " \n")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    # Rare: runs of spaces belong to the word after them.
    found = _PIECES.findall(" " + text.replace(" \n", "\n"))
    return [p[1:] if p[0] == " " else p for p in found]


class Lengths(dict):
    """Tokens of a pre-token; misses are encoded and, within bounds, kept."""

    def __init__(self, tokenizer, frequent: dict[str, int], cache: int):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.most = tokenizer, frequent, len(frequent) + cache

    def __missing__(self, part: str) -> int:
        if part == "":
            n = 1  # a space that no word follows
        else:
            n = len(self.tokenizer.encode(part)) - (part[0] == "\n")
        if len(part) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[part] = n
        return n


def frequent_parts(docs: DataFrame, entries: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all texts, at most ``entries``."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(pre_tokens(text))
                    if len(seen) > 8 * SUMMARY:
                        seen = Counter(dict(seen.most_common(2 * SUMMARY)))
        top = [(p, n) for p, n in heapq.nlargest(SUMMARY, seen.items(), key=lambda x: x[1]) if len(p) <= LONGEST]
        if top:
            parts, counts = zip(*top)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(counts, pa.int64())], ["part", "n"])

    heavy = (
        shipped(docs)
        .select(F.col("text").cast("string"))
        .mapInArrow(summaries, "part string, n long")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "part")
        .limit(entries)
    )
    return [row.part for row in heavy.select("part").collect()]


def count_tokens(
    docs: DataFrame, model: bytes, *, frequent: int = FREQUENT, cache: int = CACHE, limit: int = 4096
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    tokenizer = load(model)
    lengths = Lengths(tokenizer, {}, frequent)
    table = {p: lengths[p] for p in frequent_parts(docs, frequent)}
    sent = docs.sparkSession.sparkContext.broadcast((model, table))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = sent.value
        lengths = Lengths(sentencepiece.SentencePieceProcessor(model_proto=model), table, cache)
        get = lengths.__getitem__
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = [sum(map(get, pre_tokens(t))) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = shipped(docs).select(F.col("doc_id").cast("long"), F.col("text"), n_bytes.alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
