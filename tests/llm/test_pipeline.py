"""The corpus pipeline on a small corpus: each stage on what the one before kept, odd rows, no rows, no labels."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gondola.llm import secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("d", "k", "n", "size", "copies", "rate", "target", "taken", "source_size", "spans__", "first", "component_id", "bucket", "score")


def corpus():
    rng = random.Random(31)
    word = lambda: "".join(rng.choice(("th", "er", "on", "an", "ing", "st", "re", "ou")) for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(30)
    rows = [(i, text(rng.randint(30, 120)), "en", f"s{i % 3}") for i in range(60)]
    near = rows[4][1].split()
    near[10] = "changed"
    rows += [(100, " ".join(near), "en", "s0"), (101, rows[5][1], "en", "s1"), (102, f"{text(20)} {item} {text(20)}", "en", "s1")]
    rows += [(103, f"{text(20)} key q7Rz9LmX2vTb4KpW8sYd {text(10)}", "en", "s2"), (104, None, "en", "s0"), (105, "", None, None)]
    rows += [(None, text(50), "en", "s0"), rows[8], rows[8], (9, text(60), "en", None), (106, "12 34 !!", "en", "s2"), (107, text(4000), "en", "s1")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows], [(0, item), (1, None), (2, "")]


@pytest.fixture
def sf(spark, tmp_path):
    def make(rows, bench):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("taken") for c in CLASHES})
        docs.write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return make


def test_stages_keep_clean_documents_and_take_effect(spark, sf):
    rows, bench = corpus()
    path = sf(rows, bench)
    docs, kept, columns = spark.read.parquet(f"{path}/documents.parquet"), {}, None
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, path), f"test-{name}")
        kept[name] = sorted((r.doc_id if r.doc_id is not None else -1) for r in docs.collect())
        if name != "mixing":
            assert docs.columns == columns
        if name == "secrets":
            texts = {r.doc_id: r for r in docs.collect()}
    everything = sorted(r[0] if r[0] is not None else -1 for r in rows)
    assert set(everything) - set(kept["language"]) == {104, 105, 106}
    gone = set(kept["language"]) - set(kept["near_duplicates"])
    assert gone == {100, 101} and kept["near_duplicates"].count(8) == 1 and kept["near_duplicates"].count(9) == 2
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {102}
    assert kept["secrets"] == kept["decontamination"]
    assert "q7Rz9LmX2vTb4KpW8sYd" not in texts[103].text and "[REDACTED]" in texts[103].text and texts[103].n_chars == len(texts[103].text)
    assert set(kept["mixing"]) <= set(kept["secrets"]) and kept["mixing"]


def test_run_applies_every_stage_and_reruns_agree(spark, sf):
    path = sf(*corpus())
    first, second = (sorted(map(str, corpus_pipeline.run(spark, path).collect())) for _ in range(2))
    assert first == second and first


def test_no_documents_and_no_labels(spark, sf):
    assert corpus_pipeline.run(spark, sf([], [])).count() == 0
    rows = [(i, t, None, s, n) for i, t, _, s, n in corpus()[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert corpus_pipeline.identify_language(spark, docs, "").count() == len(rows)


def test_redaction_of_nothing_is_the_table(spark):
    docs = spark.createDataFrame([(1, "plain", None, None, 5), (2, None, None, None, None)], SCHEMA)
    assert sorted(map(str, secrets.redact(docs).collect())) == sorted(map(str, docs.collect()))
