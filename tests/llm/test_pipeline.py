"""The corpus pipeline's stages on awkward rows, and registration."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from mediapanel.llm import bpe
from tests.llm import cases
from tests.llm.test_dedup import shingles
from tests.llm.test_texts import VOCABULARY, toxic_rows


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """documents, labels and benchmark with one fault per kind."""
    d = tmp_path_factory.mktemp("sf")
    rng = random.Random(21)
    toxic = toxic_rows(240)
    rows = [(i, t) for i, t in cases.texts()] + [(1000 + i, t) for i, t, _ in toxic]
    item = cases.prose(rng, "en", 40)
    rows += [(5000, cases.prose(rng, "en", 50) + " " + item), (5001, item.upper()),
             (5002, cases.prose(rng, "en", 60) + " mail a@b.co now")]
    docs = (spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
            .withColumn("source", F.lit("s")).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1000 + i, 1, y) for i, _, y in toxic], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), {1000 + i for i, _, y in toxic if y}


def test_stages_take_effect(spark, corpus):
    d, toxic = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumns({k: F.lit(v) for k, v in cases.CLASHES.items()})
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = pipeline.written(stage(spark, docs, d), name)
        seen[name] = (before, docs.collect())
        if name != "bpe":
            assert docs.columns == columns
            assert set(map(str, seen[name][1])) <= set(map(str, before)) or name == "pii"

    gone = {r.doc_id for r in seen["toxicity"][0]} - {r.doc_id for r in seen["toxicity"][1]}
    assert len(gone & toxic) > 0.9 * len(toxic) and len(gone - toxic) < 0.03 * len(seen["toxicity"][0])

    left = [shingles(r.text, 5) for r in seen["near_dedup"][1] if shingles(r.text, 5)]
    assert not [1 for i, a in enumerate(left) for b in left[:i] if 100 * len(a & b) >= 80 * len(a | b)]
    assert {r.doc_id for r in seen["near_dedup"][1]} >= {0, 1, 2, 3, 40}

    gone = {r.doc_id for r in seen["decontamination"][0]} - {r.doc_id for r in seen["decontamination"][1]}
    assert gone == {5000, 5001}

    changed = {r.doc_id: r for r in seen["pii"][1]}
    assert changed[5002].text.endswith("mail [EMAIL] now") and changed[5002].n_chars == len(changed[5002].text)
    same = {(r.doc_id, r.text) for r in seen["pii"][0] if not re.search("[0-9@]", r.text or "")}
    assert same <= {(r.doc_id, r.text) for r in seen["pii"][1]}

    encoder = bpe.Encoder(bpe.load_vocabulary(VOCABULARY))
    want = sorted((str(r.doc_id), *encoder.encode(r.text or "")[:2]) for r in seen["bpe"][0])
    assert sorted((str(r.doc_id), bytes(r.ids), r.n_tokens) for r in seen["bpe"][1]) == want
    assert "text" not in docs.columns and "lang" in docs.columns


def test_pipeline_runs_as_registered(spark, corpus):
    d, _ = corpus
    assert entry.queries()["pipeline"](spark, d).count() > 0
    assert "pipeline" not in entry.oracle_sql() and pipeline.ORACLE_SQL is None
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
