"""Structured Streaming ingest of a landing folder (NDJSON) into bronze and
the on-platform ads fact.

readStream (declared schema) -> foreachBatch:

1. append the micro-batch to the bronze table (partitioned by ingest day).
   Nothing is dropped before bronze: a late file or a backfill lands like any
   other, and exact duplicates are harmless there;
2. recompute the rows of the report dates the batch touched from all bronze
   versions of those dates (latest ingest wins), and upsert them into the
   fact: rows of other feeds, and keys this feed does not have, stay. Only
   those ``date_local`` partitions are rewritten.

Step 2 is a deterministic function of bronze, so replaying a batch after a
failure (at-least-once delivery into bronze) converges to the same fact.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import conform, facts
from ..operators.upsert import upsert, write_partitions
from ..sources import schemas
from ..sources.io import path_exists


def landing_stream(spark: SparkSession, landing_glob: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).json(landing_glob)


def onplatform_batch(spark: SparkSession, bronze_path: str, fact_path: str, fx: DataFrame, as_of: dt.date):
    """foreachBatch body for the TikTok Ads feed."""
    empty_shopee = spark.createDataFrame([], schemas.SHOPEE_ADS_DAILY)

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lo = batch.agg(F.min("Date")).first()[0]
            (batch.withColumn("ingest_date", F.to_date("ingested_at")).write.mode("append")
             .partitionBy("ingest_date").parquet(bronze_path))
            if lo is None:
                return
            # Days in a batch: bounded by the calendar. A row is never ingested
            # before its day, so older ingest partitions hold none of them.
            touched = F.broadcast(batch.select("Date").distinct())
            bronze = spark.read.parquet(bronze_path).where(
                F.col("ingest_date").isNull() | (F.col("ingest_date") >= F.lit(lo - dt.timedelta(days=1))))
            rows = bronze.drop("ingest_date").join(touched, "Date", "left_semi")
            fact = facts.fact_onplatform_ads(conform.stg_onplatform_ads(rows, empty_shopee, fx), as_of)
            if path_exists(spark, fact_path):
                days = touched.select(F.col("Date").alias("date_local"))
                stored = spark.read.schema(fact.schema).parquet(fact_path).select(*fact.columns)
                fact = upsert(stored.where(F.col("date_local") >= F.lit(lo)).join(days, "date_local", "left_semi")
                              .select(*fact.columns), fact, facts.ONPLATFORM_KEY)
            write_partitions(fact, fact_path, "date_local", ["market", "platform"])
        finally:
            batch.unpersist()
    return run


def run_onplatform_stream(spark: SparkSession, landing_glob: str, bronze_path: str, fact_path: str,
                          checkpoint: str, fx: DataFrame, as_of: dt.date, available_now: bool = True) -> StreamingQuery:
    s = landing_stream(spark, landing_glob, schemas.TIKTOK_ADS_DAILY)
    w = s.writeStream.foreachBatch(onplatform_batch(spark, bronze_path, fact_path, fx, as_of)) \
         .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
