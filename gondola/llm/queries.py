"""One registered query per operator, over the whole given tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import (
    decontaminate, filter_audit, jaccard, language, lm, mixing, neighbours, quality, secrets, substrings, tokens, toxicity,
    vector_codes,
)
from gondola.llm.common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@registered
def op1_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf, "documents"))


@registered
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return tokens.count_tokens(_table(spark, sf, "documents"), model)


@registered
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs, remainder = _table(spark, sf, "documents"), crc_mod("doc_id", 4)
    found = language.predict(docs, language.fit(docs, remainder != 2))
    return found.withColumn("held_out", remainder == 2)


@registered
def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.dedup(_table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@registered
def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    spans = secrets.scan(_table(spark, sf, "documents"))
    base = F.filter("spans", lambda m: m["kind"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written_out(base), 256).alias("base_sha256"),
        secrets.written_out(F.col("spans")).alias("spans"),
    )


@registered
def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@registered
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf, "documents"), _table(spark, sf, "benchmark")).distinct()


@registered
def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs, remainder = _table(spark, sf, "documents"), crc_mod("doc_id", 7)
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    ids = lm.encode(docs, remainder != 2, model)
    return lm.score(docs, *lm.fit(docs, remainder != 2, model, ids), ids).withColumn("held_out", remainder == 2)


@registered
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, remainder = _table(spark, sf, "documents"), crc_mod("doc_id", 5)
    model = quality.fit(docs, _table(spark, sf, "labels"), remainder != 0)
    return quality.score(docs, model).withColumn("held_out", remainder == 0)


@registered
def op10_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return neighbours.search(vectors.where("vec_id % 50 = 0"), vectors, k=5, factor=1.0)


@registered
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@registered
def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, remainder = _table(spark, sf, "documents"), crc_mod("doc_id", 5)
    model = toxicity.fit(docs, _table(spark, sf, "labels"), remainder != 0)
    return toxicity.score(docs, model).withColumn("held_out", remainder == 0)


@registered
def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, books = vector_codes.encode(_table(spark, sf, "embeddings"))
    digest = F.lit(vector_codes.codebooks_digest(books)).alias("codebooks_sha256")
    return vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)


ORACLES["op11_filter_audit"] = filter_audit.ORACLE
ORACLES["op13_vector_codes"] = vector_codes.ORACLE
