"""Toxicity by a weighted lexicon.

Texts are folded: compatibility forms and accents taken apart, letters of other scripts that look like Latin
ones replaced, digits and signs that stand for letters inside a word read as letters, ``l`` and ``i`` as one
letter; invisible characters go, everything that is no letter parts words. An Aho-Corasick automaton over the
folded words holds terms (whole words and beginnings of words) with weights and exception phrases of two
words with weight 0. The leftmost, longest match wins, so an exception phrase hides the terms in it. The sum of
the weights, divided by the length in words, goes through a logistic curve.

Lexicon, exceptions and curve are learned from labels: a term's weight is the log of its share among toxic
documents over its share among others, both smoothed, counted where it is the match. An exception is a pair
of neighbouring words around a match that documents of the other class have and toxic ones as good as never,
judged among the documents with a match. The curve is fitted on documents scored with the weights of the other
half of the sample, so it knows how well the terms do on texts they were not learned from.

The fit uses a bounded sample: about ``per_class`` labelled documents of each class, picked by a hash of
the id; at most ``TERMS`` terms and ``PHRASES`` exceptions are kept, the most telling ones. Term and phrase counts are
Spark aggregates.
Scoring reads every whole text in place, without a shuffle.

Edge cases: null text is empty; texts without a letter have the score of no match; labels that are null or
have no document are left out, an id with both labels counts in both classes; without both classes every score
is 0; repeated rows are scored each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import column_bytes, shipped, written

PER_CLASS = 2500
CUT = 0.5
TERMS, PHRASES = 4096, 1024
PREFIXES = range(3, 11)
LEAST_DOCS, LEAST_WEIGHT = 4, 1.5
SURE = 20.0  # likelihood ratio of a term's documents against chance
ANY = ""  # counts the documents with a match among the phrases
PAD = 10.0  # words added to every length: one match in a very short text is not a rate of its own

# Letters that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "ԍ": "g", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w",
    "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ɑ": "a", "ɡ": "g", "ı": "i", "ʟ": "l", "ո": "n", "օ": "o", "ս": "u", "հ": "h",
}
SUBSTITUTIONS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i",
}

_LETTERS = str.maketrans(HOMOGLYPHS | {"l": "i"})
_SIGNS = str.maketrans(SUBSTITUTIONS)
_MIXED = re.compile(r"[^\W_]*[0-9@$!|][^\W_0-9]*(?:[0-9@$!|]+[^\W_0-9]*)*")
_INVISIBLE = re.compile("[­̀-ͯ​-‏⁠-⁤︀-️﻿]")
_WORD = re.compile(r"[^\W\d_]+")


def _read_signs(match: re.Match) -> str:
    """A word with digits or signs in it, read as letters; numbers and closing marks stay."""
    word = match.group()
    core = word.rstrip("!|@$")
    return core.translate(_SIGNS) + " " if any(c.isalpha() for c in core) else word


def folded(text: str) -> list[str]:
    """The words of a text after folding."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).lower()
    return _WORD.findall(_MIXED.sub(_read_signs, text).translate(_LETTERS))


def terms(words: list[str]) -> set[str]:
    """Whole words and beginnings of words, marked as in the automaton."""
    found = set()
    for w in set(words):
        found.update(f"<{w[:k]}" for k in PREFIXES if k < len(w))
        found.add(f"<{w}>")
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]  # term or exception phrase (0), in the automaton's marks

    def __post_init__(self):
        self._automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "_automaton": None}

    def matches(self, words: list[str]) -> list[tuple[int, str]]:
        """End positions in ``marked(words)`` and terms of the leftmost longest matches."""
        if not self.weights or not words:
            return []
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for term in self.weights:
                self._automaton.add_word(term, term)
            self._automaton.make_automaton()
        return list(self._automaton.iter_long(marked(words)))

    def rate(self, words: list[str]) -> float:
        """Weight of the matches per word."""
        return sum(self.weights[term] for _, term in self.matches(words)) / (len(words) + PAD)


def marked(words: list[str]) -> str:
    return f"<{'><'.join(words)}>" if words else ""


@dataclass
class Model:
    lexicon: Lexicon
    curve: tuple[float, float]  # offset and slope over the log of the rate

    def score(self, text: bytes) -> float:
        return float(probability(np.array([self.lexicon.rate(folded(text.decode(errors="replace")))]), self.curve)[0])


def probability(rate: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * np.log(rate + 1e-3), -30, 30)))


def fitted_curve(rate: np.ndarray, toxic: np.ndarray, mass: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Offset and slope of the logistic curve, by Newton steps on the weighted, lightly ridged likelihood."""
    x = np.stack([np.ones(len(rate)), np.log(rate + 1e-3)], axis=1)
    scale = mass.sum() / len(mass)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (mass * (p - toxic)) / scale + ridge * np.array([0.0, w[1]])
        hessian = (x * (mass * p * (1 - p) / scale)[:, None]).T @ x + np.diag([1e-6, ridge])
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
    return float(w[0]), float(w[1])


def _sample(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """toxic, half and text of the sample, and the labelled documents of each class."""
    known = labels.where(learn & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int")).distinct()
    classes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        return docs.limit(0), classes
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, per_class / classes[1]).otherwise(per_class / classes[0])
    picked = known.where(draw < share).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
    # About 2 * per_class rows, whatever the size of the labels: broadcast, so no text is shuffled.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("toxic", "half", "text"), classes


_SIDES = ("clean0", "toxic0", "clean1", "toxic1")  # class and half


def _counted(sample: DataFrame, found) -> DataFrame:
    """term and its documents by class and half, for the set of terms that ``found`` gives for a text's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides: list[Counter] = [Counter() for _ in _SIDES]
            for toxic, half, words in zip(*(batch.column(c).to_pylist() for c in ("toxic", "half", "words"))):
                sides[2 * half + toxic].update(found(words.split()))
            for i, side in enumerate(sides):
                counts = [pa.array(list(side.values()) if i == j else [0] * len(side), pa.int64()) for j in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(list(side), pa.string()), *counts], ["term", *_SIDES])

    schema = "term string, " + ", ".join(f"{s} long" for s in _SIDES)
    return shipped(sample).mapInArrow(run, schema).groupBy("term").agg(*(F.sum(s).alias(s) for s in _SIDES))


def _folded_rows(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [" ".join(folded(t.decode(errors="replace"))) for t in column_bytes(batch)]
            columns = [batch.column("toxic"), batch.column("half"), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "half", "words"])

    return shipped(sample).mapInArrow(run, "toxic int, half int, words string")


def _odds(a, b, n_a: int, n_b: int, log):
    return log((a + 0.5) / (n_a + 1)) - log((b + 0.5) / (n_b + 1))


def _surprise(a, b, n_a: int, n_b: int, log):
    """Twice the log likelihood ratio of a term's documents by class against the shares of the classes."""
    every = (a + b) / (n_a + n_b)
    return 2 * (a * log((a + 1e-9) / (every * n_a)) + b * log((b + 1e-9) / (every * n_b)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS, exceptions: tuple[str, ...] = ()) -> Model | None:
    """The model of the labels where ``learn`` holds; None without both classes. ``exceptions`` are phrases
    that never count, beside the learned ones."""
    rows, classes = _sample(docs, labels, learn, per_class)
    if len(classes) < 2:
        return None
    rows = written(_folded_rows(rows), "toxicity-sample")
    spark = rows.sparkSession
    sizes = {(r.toxic, r.half): r["count"] for r in rows.groupBy("toxic", "half").count().collect()}
    half = [(sizes.get((1, h), 0), sizes.get((0, h), 0)) for h in (0, 1)]
    both = half[0][0] + half[1][0], half[0][1] + half[1][1]
    if not all(both):
        return None

    def telling(counted: DataFrame, a: Column, b: Column, n_a: int, n_b: int, limit: int) -> DataFrame:
        """The terms that documents of one class have far more often than those of the other, most telling first."""
        odds = _odds(a, b, n_a, n_b, F.log)
        fits = (a >= LEAST_DOCS) & (odds >= LEAST_WEIGHT) & (_surprise(a, b, n_a, n_b, F.log) >= SURE)
        return counted.where(fits).orderBy(F.desc(a * odds), "term").limit(limit)  # a fixed bound

    toxic, clean = F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1")
    kept = telling(_counted(rows, terms), toxic, clean, *both, TERMS).toPandas()
    # A beginning of a word is judged by the words that no longer term explains: terms are counted where they
    # match, the ones that tell nothing there go, and what is left is counted again for the weights.
    for round_ in range(3):
        sent = spark.sparkContext.broadcast(Lexicon(dict.fromkeys(kept["term"], 1.0)))
        matched = _counted(rows, lambda words, sent=sent: {term for _, term in sent.value.matches(words)})
        kept = (telling(matched, toxic, clean, *both, TERMS) if round_ < 2 else matched).toPandas()
    count = [(kept[f"toxic{h}"].to_numpy(np.float64), kept[f"clean{h}"].to_numpy(np.float64)) for h in (0, 1)]
    weigh = lambda t, c, n: dict(zip(kept["term"], np.maximum(0.0, _odds(t, c, *n, np.log)).tolist()))
    whole = weigh(count[0][0] + count[1][0], count[0][1] + count[1][1], both)

    sent = spark.sparkContext.broadcast(Lexicon(whole))  # TERMS entries
    around = written(_counted(rows, lambda words: phrases(words, sent.value)), "toxicity-phrases")
    matching = around.where(F.col("term") == ANY).select(clean.alias("clean"), toxic.alias("toxic")).first() or (0, 0)
    calm = telling(around.where(F.col("term") != ANY), clean, toxic, *matching, PHRASES).select("term").collect() if all(matching) else []
    spared = {marked(folded(x)): 0.0 for x in exceptions if folded(x)} | {r.term: 0.0 for r in calm}
    # The half a document is in never gives the weights it is scored with here.
    other = spark.sparkContext.broadcast([Lexicon(weigh(*count[1 - h], half[1 - h]) | spared) for h in (0, 1)])

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = [other.value[h].rate(w.split()) for h, w in zip(*(batch.column(c).to_pylist() for c in ("half", "words")))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rate, pa.float64())], ["toxic", "rate"])

    scored = rows.mapInArrow(rates, "toxic int, rate double").toPandas()  # the sample's numbers
    scored = scored.sort_values(["toxic", "rate"])  # sums do not depend on the order rows came in
    y = scored["toxic"].to_numpy(np.float64)
    # Each class weighs as much as among the labels, not as in the sample.
    mass = np.where(y == 1, classes[1] / y.sum(), classes[0] / (1 - y).sum())
    return Model(Lexicon(whole | spared), fitted_curve(scored["rate"].to_numpy(), y, mass))


def phrases(words: list[str], lexicon: Lexicon) -> set[str]:
    """Each word that holds a match, with the word before it and with the one after it; ANY if there is one."""
    ends = [end for end, _ in lexicon.matches(words)]
    if not ends:
        return set()
    edge = np.cumsum([len(w) + 2 for w in words])
    hit = np.searchsorted(edge, ends, side="right")
    found = {ANY} | {marked(words[i - 1 : i + 1]) for i in hit.tolist() if i}
    return found | {marked(words[i : i + 2]) for i in hit.tolist() if i + 1 < len(words)}


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score at least CUT) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # TERMS + PHRASES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = [model.score(t) if model else 0.0 for t in column_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    rows = shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
