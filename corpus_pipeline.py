"""Corpus pipeline: five stages over ``documents``, each writing its rows as
Parquet that the next one reads.

Stages take (spark, docs, sf_dir). The first four return the columns of their
input; the last one returns them without the text, with its tokens. Null and
empty texts pass every filter; clashing extra columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediapanel.llm import bpe, decontaminate, near_dedup, pii, toxicity
from mediapanel.llm.common import table, written
from mediapanel.llm.queries import vocabulary_path

SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    own = {c: f"__in_{c}" for c in docs.columns if c != "text"}
    scored = toxicity.score(docs.withColumnsRenamed(own).withColumn("__text_in", F.col("text")), model)
    return scored.where("predicted = 0").select(
        *[F.col("__text_in").alias("text") if c == "text" else F.col(own[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup.deduplicated(docs, words=SHINGLE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows are told apart by id and text."""
    keyed = docs.withColumn("__key", pii.row_key())
    leaks = decontaminate.contaminated(keyed.select(F.col("__key").alias("doc_id"), "text"),
                                       table(spark, sf_dir, "benchmark"))
    return keyed.join(leaks.select(F.col("doc_id").alias("__key")).distinct(), "__key", "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become the name of their kind; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (32-bit little-endian), their number and hash, and the hash of
    the decoded text take the place of the text."""
    made = {"text", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    keep = tuple(c for c in docs.columns if c not in made)
    return bpe.encode_texts(docs, vocabulary_path(), keep=keep, outputs=("ids",))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("bpe", encode),
]

# Compression lengths, sketches and token merges have no SQL form; the tests
# hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
