"""Stateful streaming ingest of all nine feeds into bronze and the four facts.

Per feed, one query appends the landing files to bronze (file sink: each file
exactly once), with no watermark: late rows land like any other. A file is known
by its path, so each landing run writes a folder of its own,
``<landing>/<feed>/<run>/...``.

Per fact, one query keeps the latest version of every key in the state store
(``max_by`` over the same total order as the batch dedup, in update mode) and
emits the keys whose version changed. ``foreachBatch`` upserts these into a
silver table of latest rows and rebuilds the fact of the touched days from it.
The watermark trails the latest event day by ``delay`` (T-14): state of older
days is dropped, and so are rows for them, which makes those days final; bronze
still gets the rows.

State is one row per key of the last ``delay`` days, spread over the shuffle
partitions by key; use the RocksDB state store when it outgrows the heap. Both
writes of a batch are functions of the state's output, which the checkpoint
replays as it was, so a batch run again after a failure gives the same tables.
A key keeps its day: versions of an order share their create time and market.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import conform, facts
from ..operators.upsert import upsert, write_partitions
from ..sources import io, schemas

FINAL_AFTER = "14 days"


def stateful_latest(event: str, delay: str) -> conform.Dedup:
    """The batch dedup as a streaming aggregation: per key, and event day so
    that old state can go, the row with the largest order."""
    def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        day = F.date_trunc("day", F.col(event).cast("timestamp"))
        latest = (df.withColumn("_event", day).withWatermark("_event", delay).groupBy(*keys, "_event")
                  .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest")))
        return latest.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])
    return dedup


@dataclass(frozen=True)
class Stream:
    """One fact: the feeds it is made of, its latest rows, their key, the fact."""
    feeds: tuple[str, ...]
    latest: Callable[..., DataFrame]
    key: list[str]
    fact: Callable[[DataFrame], DataFrame]


class Ingest:
    def __init__(self, spark: SparkSession, landing: str, base: str, fx: DataFrame, dim_market: DataFrame,
                 traffic_map: DataFrame, as_of: dt.date, delay: str = FINAL_AFTER):
        self.spark, self.landing, self.base = spark, landing.rstrip("/"), base.rstrip("/")
        on_days = stateful_latest("date_report", delay)

        def evc(google, meta, tiktok):
            # Conversions have no versions: the same row again is a replay.
            told = [f.withColumn("_row", F.sha2(F.to_json(F.struct(*f.columns)), 256)) for f in (google, meta, tiktok)]
            rows = conform.evc_rows(*told, keep=("_row",))
            return stateful_latest("date_local", delay)(rows, ["_row", "channel"], ["market"])

        self.streams = {
            "fact_platform_sales": Stream(
                ("shopee_orders", "tiktok_shop_orders"),
                lambda s, t: conform.stg_platform_sales(s, t, dim_market, traffic_map,
                                                        dedup=stateful_latest("create_time_utc", delay)),
                ["platform", "order_id", "sku_id"], lambda r: facts.fact_platform_sales(r, fx, as_of)),
            "fact_onplatform_ads": Stream(
                ("tiktok_ads_daily", "shopee_ads_daily"),
                lambda t, s: conform.stg_onplatform_ads(t, s, fx, dedup=on_days),
                ["platform", "date_local", "market", "campaign_id", "ad_group_id", "sku_id", "ad_type", "ad_key"],
                lambda r: facts.fact_onplatform_ads(r, as_of)),
            "fact_offplatform_ads": Stream(
                ("meta_cpas_daily", "google_ads_shopee_daily"),
                lambda m, g: conform.stg_offplatform_ads(m, g, fx, dedup=on_days),
                ["platform", "date_local", "market", "campaign_id", "ad_set_or_ad_group_id", "ad_key"],
                lambda r: facts.fact_offplatform_ads(r, as_of)),
            "fact_evc": Stream(
                ("evc_google", "evc_meta", "evc_tiktok"), evc, ["_row", "channel"],
                lambda r: facts.fact_evc(conform.evc_totals(r), dim_market, fx, as_of)),
        }

    def path(self, *parts: str) -> str:
        return "/".join((self.base, *parts))

    def read(self, feed: str) -> DataFrame:
        folder = f"{self.landing}/{feed}"
        fs, p = io._fs(self.spark, folder)
        fs.mkdirs(p)
        return (self.spark.readStream.schema(schemas.RAW_SCHEMAS[feed]).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.ndjson").json(folder))

    def maintain(self, name: str):
        """foreachBatch body: changed rows into silver, touched days of the fact."""
        spec, silver, fact = self.streams[name], self.path("silver", name), self.path(name)

        def run(batch: DataFrame, epoch_id: int) -> None:
            rows = batch.where(F.col("date_local").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                # Days of a batch: bounded by the calendar.
                touched = F.broadcast(rows.select("date_local").distinct())
                if touched.isEmpty():
                    return
                merged = rows
                if io.path_exists(self.spark, silver):
                    stored = self.spark.read.schema(rows.schema).parquet(silver).select(*rows.columns)
                    merged = upsert(stored.join(touched, "date_local", "left_semi").select(*rows.columns), rows, spec.key)
                write_partitions(merged, silver)
                latest = self.spark.read.schema(rows.schema).parquet(silver).join(touched, "date_local", "left_semi")
                write_partitions(spec.fact(latest), fact, "date_local", [c for c in ("market", "platform") if c in rows.columns])
            finally:
                rows.unpersist()
        return run

    def start(self, available_now: bool = True) -> list[StreamingQuery]:
        """All thirteen queries; a checkpoint each under ``base``."""
        def started(writer, name):
            writer = writer.queryName(name).option("checkpointLocation", self.path("_checkpoints", name))
            return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()

        out = []
        for feed in schemas.RAW_SCHEMAS:
            rows = self.read(feed).withColumn("ingest_date", F.to_date("ingested_at"))
            out.append(started(rows.writeStream.format("parquet").partitionBy("ingest_date")
                               .option("path", self.path("bronze", feed)), f"bronze-{feed}"))
        for name, spec in self.streams.items():
            rows = spec.latest(*[self.read(f) for f in spec.feeds])
            out.append(started(rows.writeStream.outputMode("update").foreachBatch(self.maintain(name)), name))
        return out

    def run(self, timeout: int = 600) -> None:
        """Everything that has landed, then stop."""
        queries = self.start()
        try:
            for q in queries:
                q.awaitTermination(timeout)
                if q.exception() is not None:
                    raise q.exception()
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
