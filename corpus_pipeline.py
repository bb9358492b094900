"""From raw documents to a training mixture: five stages, each written as Parquet and read again.

Edge cases: null and empty texts and texts without a letter are rejected by the language stage; without any
labelled document it rejects none. Rows with a null id are judged by their text; rows of one id with different texts
are documents of their own, equal rows count as one from the second stage on. Null and empty benchmark items
match nothing. A null source is a source. Further columns are kept as they are, whatever their names; an empty
table stays empty. A stage that failed is run again from what the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gondola.llm import decontaminate, jaccard, language, mixing, secrets
from gondola.llm.common import crc_mod, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language; the rest goes. Learns from the documents it is given."""
    model = language.fit(docs, crc_mod("doc_id", 4) != 2)
    return language.keep_identified(docs, model)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return jaccard.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with their copies."""
    return mixing.mixture(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", join_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# SQL expresses neither the language model nor the edit distance search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
