"""Language identification by nearest centroid.

A text is a vector of hashed byte 2- and 3-grams (ASCII letters in lower case, every other ASCII
character a space), log counts times inverse document frequency, length 1. Each language has a few
centroids, found by spherical k-means over its sample; the language of the nearest centroid by
cosine wins. A document whose similarity is under its language's threshold is rejected. Similarity
grows with the number of distinct n-grams, so texts with at least ``DISTINCT`` are held to the similarities
of the sample's texts of their band (bands double in width; one with few texts takes the threshold of the
band before). For other texts, short or of repeated words, the threshold lies far under the similarities of the whole sample, and shrinks
with the root of the number of n-grams for texts too short to be near anything.

The fit uses a bounded sample of labelled rows: about ``per_language`` documents of each language,
picked by a hash of the id. Prediction reads every whole text in place, without a shuffle.

Edge cases: null text and text without a letter are ``und`` with score 0 and rejected; without any
labelled row every prediction is ``und`` and nothing is rejected, as nothing is known of any language; repeated rows are predicted each; an empty table gives no rows;
lang and source never enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import column_bytes, shipped

DIMS = 4096
PER_LANGUAGE = 800
CENTROIDS = 3
SHARPNESS = 20.0
SLACK = 0.5
BLOCK = 256
FULL = 400  # n-grams from which the whole threshold holds
DISTINCT = 100  # distinct n-grams from which the thresholds of the bands hold
BANDS = 6
BAND_SLACK = 0.65
BAND_LEAST = 20  # texts of a band that make a threshold
_LETTER = regex.compile(r"\p{L}")  # Unicode letters only: no fractions, circled or Roman numerals
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)], np.uint32)


def counts(text: bytes) -> np.ndarray:
    """Counts of hashed 2- and 3-grams."""
    c = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] + c[2:] * np.uint32(0xC2B2AE35)
    cells = np.concatenate((two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1))) >> np.uint32(20)
    return np.bincount(cells, minlength=DIMS)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # DIMS
    centroids: np.ndarray  # rows of length 1
    owner: np.ndarray  # language index of each centroid
    threshold: np.ndarray  # of each language, for texts under the first band
    bands: np.ndarray  # thresholds of each language and band

    def predict(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, its cosine, and its share of the languages' weights."""
        cosine = unit(tf, self.idf) @ self.centroids.T
        best = np.stack([cosine[:, self.owner == i].max(axis=1) for i in range(len(self.languages))], axis=1)
        winner = best.argmax(axis=1)
        top = best[np.arange(len(best)), winner]
        return winner, top, 1.0 / np.exp(SHARPNESS * (best - top[:, None])).sum(axis=1)

    def rejects(self, tf: np.ndarray, winner: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        short = self.threshold[winner] * np.sqrt(np.minimum(1.0, tf.sum(axis=1) / FULL))
        band = _band(tf)
        return cosine < np.where(band < 0, short, self.bands[winner, band])


def _band(tf: np.ndarray) -> np.ndarray:
    """Band by the number of distinct n-grams; -1 under the first."""
    distinct = np.maximum(1, (tf > 0).sum(axis=1))
    return np.clip(np.floor(np.log2(distinct / DISTINCT)), -1, BANDS - 1).astype(np.int64)


def unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(tf.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from farthest-first seeds."""
    seeds = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        seeds.append(x[(np.stack(seeds) @ x.T).max(axis=0).argmin()])
    c = np.stack(seeds)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model | None:
    """The model of the rows where ``learn`` holds; None without labelled rows."""
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = labelled.groupBy("lang").count().select("lang", (F.lit(float(per_language)) / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.select("doc_id", "text", "lang", draw.alias("draw")).join(F.broadcast(share), "lang").where("draw < share")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, values = [], []
            for text in column_bytes(batch):
                tf = counts(text)
                at = np.flatnonzero(tf)
                cells.append(at.astype("<u2").tobytes())
                values.append(tf[at].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(cells, pa.binary()), pa.array(values, pa.binary())],
                ["lang", "cells", "counts"],
            )

    rows = shipped(sample).select("lang", "text").mapInArrow(vectors, "lang string, cells binary, counts binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, bytes(r.cells), bytes(r.counts)))
    tf = np.zeros((len(rows), DIMS), np.float32)
    for i, row in enumerate(rows):
        tf[i, np.frombuffer(row.cells, "<u2")] = np.frombuffer(row["counts"], "<u4")
    languages = sorted({r.lang for r in rows})
    idf = (np.log((1 + len(rows)) / (1 + (tf > 0).sum(axis=0))) + 1).astype(np.float32)
    x, label = unit(tf, idf), np.array([languages.index(r.lang) for r in rows])
    own = [_kmeans(x[label == i], centroids) for i in range(len(languages))]
    near = [np.quantile((x[label == i] @ c.T).max(axis=1), 0.001) for i, c in enumerate(own)]
    short = SLACK * np.array(near)
    model = Model(
        languages,
        idf,
        np.concatenate(own).astype(np.float32),
        np.repeat(np.arange(len(own)), [len(c) for c in own]),
        short,
        np.repeat(short[:, None], BANDS, axis=1),
    )
    # By the language that wins, as in prediction: a wrong label does not lower a threshold.
    parts = [model.predict(tf[i : i + BLOCK])[:2] for i in range(0, len(tf), BLOCK)]
    winner, cosine = (np.concatenate(p) for p in zip(*parts))
    bands = _band(tf)
    for i in range(len(languages)):
        for band in range(BANDS):
            some = cosine[(winner == i) & (bands == band)]
            if len(some) >= BAND_LEAST:
                model.bands[i, band:] = BAND_SLACK * np.quantile(some, 0.001)
    return model


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, all columns, that are not rejected; all of them without a model. Rows are filtered where
    they are read."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            texts = column_bytes(batch)
            rows = [i for i, t in enumerate(texts) if _LETTER.search(t.decode(errors="replace"))]
            for start in range(0, len(rows), BLOCK):
                some = rows[start : start + BLOCK]
                tf = np.stack([counts(texts[i]) for i in some])
                kept[some] = ~model.rejects(tf, *model.predict(tf)[:2])
            yield batch.filter(pa.array(kept)).select(columns)

    return shipped(docs).mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, similarity (cosine of the nearest centroid), rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: languages x centroids x DIMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = column_bytes(batch)
            n = len(texts)
            lang, score = np.full(n, "und", object), np.zeros(n)
            near, rejected = np.zeros(n), np.full(n, model is not None)
            with_letter = [i for i, t in enumerate(texts) if _LETTER.search(t.decode(errors="replace"))] if model else []
            for start in range(0, len(with_letter), BLOCK):
                rows = with_letter[start : start + BLOCK]
                tf = np.stack([counts(texts[i]) for i in rows])
                winner, cosine, share = model.predict(tf)
                lang[rows] = np.array(model.languages, object)[winner]
                score[rows], near[rows] = share, np.clip(cosine, 0, 1)
                rejected[rows] = model.rejects(tf, winner, cosine)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(near), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "similarity", "rejected"],
            )

    rows = shipped(docs).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, similarity double, rejected boolean")
