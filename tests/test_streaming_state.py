"""Stateful ingest of all feeds: parity with the batch chain, late and
replayed files, final days."""

from __future__ import annotations

import datetime as dt
import shutil

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediapanel.operators import conform, facts
from mediapanel.sources import bind, io, schemas, seeds
from mediapanel.streaming.state import Ingest

from .conftest import SMALL

DAY = {**{f: "Date" for f in schemas.RAW_SCHEMAS}, "evc_google": "date", "evc_meta": "date", "evc_tiktok": "date"}


def rows_of(df):
    cols = [F.round(F.col(f.name).cast("double"), 6).alias(f.name) if isinstance(f.dataType, (T.DecimalType, T.DoubleType))
            else F.col(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_all_feeds_match_the_batch(spark, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "base")
    raw = bind.Bronze(spark, SMALL)
    fx, market, traffic = bind.test_fx(spark), seeds.dim_market(spark), seeds.traffic_source_map(spark)
    job = Ingest(spark, landing, base, fx, market, traffic, bind.AS_OF)
    day = lambda n: F.lit(bind.WINDOW_START + dt.timedelta(n))

    def land(run, part, only=None):
        return {f: io.write_landing(part(raw[f], F.col(DAY[f])), f"{landing}/{f}", run, DAY[f]) for f in only or schemas.RAW_SCHEMAS}

    # First a part of the rows of the first 20 days: older versions alone, where there are two.
    early = F.pmod(F.xxhash64("ingested_at"), F.lit(3)) != 0
    cut = 20
    n1 = land("run1", lambda df, d: df.where((d < day(cut)) & early))
    job.run()
    for f, n in n1.items():
        assert spark.read.parquet(f"{base}/bronze/{f}").count() == n
    # The rest of the days before, which is late but within 14 days of the
    # latest day seen, and the days after; and a file once more under another name.
    for f in schemas.RAW_SCHEMAS:
        source = next((tmp_path / "landing" / f).glob("run1/*/*.ndjson"))
        shutil.copy(source, source.with_name("again.ndjson"))
    land("run2", lambda df, d: df.where((d >= day(6)) & ~((d < day(cut)) & early)))
    job.run()

    def chain(keep):
        r = {f: raw[f].where(keep(f, F.col(DAY[f]))) for f in schemas.RAW_SCHEMAS}
        return {
            "fact_platform_sales": facts.fact_platform_sales(conform.stg_platform_sales(
                r["shopee_orders"], r["tiktok_shop_orders"], market, traffic), fx, bind.AS_OF),
            "fact_onplatform_ads": facts.fact_onplatform_ads(conform.stg_onplatform_ads(
                r["tiktok_ads_daily"], r["shopee_ads_daily"], fx), bind.AS_OF),
            "fact_offplatform_ads": facts.fact_offplatform_ads(conform.stg_offplatform_ads(
                r["meta_cpas_daily"], r["google_ads_shopee_daily"], fx), bind.AS_OF),
            "fact_evc": facts.fact_evc(conform.stg_evc(r["evc_google"], r["evc_meta"], r["evc_tiktok"]), market, fx, bind.AS_OF)}

    want = chain(lambda f, d: (d >= day(6)) | ((d < day(cut)) & early))
    for name, df in want.items():
        got = spark.read.parquet(f"{base}/{name}").select(*df.columns)
        assert got.count() > 0 and rows_of(got) == rows_of(df), name

    # A version of a day that is final by now: bronze has it, the fact stays.
    before = rows_of(spark.read.parquet(f"{base}/fact_onplatform_ads"))
    n = land("run3", lambda df, d: df.where(d < day(3)).limit(5).withColumn("Spend", F.lit(999).cast("decimal(18,4)"))
             .withColumn("ingested_at", F.lit("2030-01-01").cast("timestamp")), ["shopee_ads_daily"])["shopee_ads_daily"]
    bronze = spark.read.parquet(f"{base}/bronze/shopee_ads_daily").count()
    job.run()
    assert n > 0 and spark.read.parquet(f"{base}/bronze/shopee_ads_daily").count() == bronze + n
    assert rows_of(spark.read.parquet(f"{base}/fact_onplatform_ads")) == before
