"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediapanel.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back:
    lineage ends there, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """``value`` sent to the tasks by broadcast, pickled by value like task code:
    it may hold objects of this subpackage where executors have no copy of it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))
