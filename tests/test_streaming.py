"""Streaming ingest into a fact that other feeds have written too."""

from __future__ import annotations

import shutil

from pyspark.sql import functions as F

from mediapanel.operators import conform, facts
from mediapanel.operators.upsert import write_partitions
from mediapanel.sources import bind, io, schemas
from mediapanel.streaming.ingest import run_onplatform_stream

from .conftest import SMALL

COLS = ["date_local", "market", "platform", "ad_type", "objective", "campaign_id", "ad_group_id", "sku_id",
        "attribution_window", "impressions", "clicks", "direct_orders"]


def _rows(df):
    money = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("spend_usd", "direct_gmv_usd")]
    return sorted((tuple(r) for r in df.select(*COLS, *money).collect()), key=str)


def test_stream_into_a_shared_fact(spark, tmp_path):
    """Shopee rows are in the fact already; TikTok files land in two runs, the
    second with a file replayed under another name and one that is late (its
    rows were ingested long before those of the first run)."""
    fx = bind.test_fx(spark)
    raw = bind.tiktok_ads_daily(spark, SMALL)
    shopee = bind.shopee_ads_daily(spark, SMALL)
    empty = spark.createDataFrame([], schemas.TIKTOK_ADS_DAILY)
    fact, bronze, ckpt, landing = (str(tmp_path / n) for n in ("fact", "bronze", "ckpt", "landing"))
    write_partitions(facts.fact_onplatform_ads(conform.stg_onplatform_ads(empty, shopee, fx), bind.AS_OF), fact)
    before = _rows(spark.read.parquet(fact))

    def run():
        q = run_onplatform_stream(spark, f"{landing}/tiktok_ads/*/*.ndjson", bronze, fact, ckpt, fx, bind.AS_OF)
        q.awaitTermination(300)
        assert q.exception() is None

    first_days = raw.agg(F.date_add(F.min("Date"), 2)).first()[0]
    late = F.col("Date") <= F.lit(first_days)
    n = io.write_landing(raw.where(~late), landing, "tiktok_ads")
    run()
    assert spark.read.parquet(bronze).count() == n
    # The same rows again in files of other names, and the late days.
    source = next((tmp_path / "landing" / "tiktok_ads").glob("*/*.ndjson"))
    replayed = sum(1 for _ in source.open())
    shutil.copy(source, source.with_name("again.ndjson"))
    m = io.write_landing(raw.where(late), landing, "tiktok_ads")
    run()
    assert spark.read.parquet(bronze).count() == n + m + replayed == raw.count() + replayed

    got = spark.read.parquet(fact)
    assert _rows(got.where("platform = 'shopee_ads'")) == before
    want = facts.fact_onplatform_ads(conform.stg_onplatform_ads(raw, shopee, fx), bind.AS_OF)
    assert _rows(got) == _rows(want)
