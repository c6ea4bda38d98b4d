"""IO operators (IO3, IO5, IO7, IO9, PF16), views and report compositions."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mediapanel.operators import conform, metrics
from mediapanel.plans.chain import Chain
from mediapanel.plans.reports import channel_brief, daily_report
from mediapanel.sources import bind, io, schemas

from .conftest import SMALL, rows


def test_replay_landing_reads_market_from_path(spark, tmp_path):
    d = tmp_path / "land" / "tiktok_ads" / "TH"
    d.mkdir(parents=True)
    (d / "2024-01-01.ndjson").write_text('{"Date": "2024-01-01", "Spend": 1.0}\n\n')
    (d / "notes.txt").write_text("ignored")
    df = io.replay_landing(spark, str(tmp_path / "land"), "tiktok_ads", schemas.TIKTOK_ADS_DAILY)
    assert [(r["_market"], float(r["Spend"])) for r in rows(df)] == [("TH", 1.0)]
    assert io.replay_landing(spark, str(tmp_path / "land"), "missing_source", schemas.TIKTOK_ADS_DAILY) is None


def test_csv_sink_nulls_and_order(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), None, True, "TH")],
                               "Date date, Spend double, flag boolean, _market string")
    io.write_csv(df, str(tmp_path / "csv"), ["Spend", "Date"])
    parts = [f for f in os.listdir(tmp_path / "csv") if f.endswith(".csv")]
    lines = [ln for f in parts for ln in (tmp_path / "csv" / f).read_text().splitlines()]
    assert set(ln for ln in lines if ln.startswith("Spend")) == {"Spend,Date,_market,flag"}
    assert [ln for ln in lines if not ln.startswith("Spend")] == [",2024-01-02,TH,true"]


def test_extract_window_lineage_and_accounts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d), f"a{d % 2}") for d in range(1, 31)], "Date date, acct string")
    w = io.extract_window(df, "Date", dt.date(2024, 1, 30), 14)
    assert w.count() == 14
    acc = spark.createDataFrame([("meta", "TH", ["a1"]), ("meta", "ID", ["a0", "a9"])],
                                "source string, market string, account_ids array<string>")
    tagged = rows(io.tag_lineage(w, "meta_api", io.accounts_for(acc, "meta"), dt.date(2024, 1, 30),
                                 account_col="acct"))
    assert {r["_market"] for r in tagged} == {"TH", "ID"} and tagged[0]["_window_start"] == dt.date(2024, 1, 17)
    assert io.restrict_to_accounts(w, io.accounts_for(acc, "meta", "TH"), "acct").count() == 7


def test_exclude_simulated(spark):
    df = spark.createDataFrame([("x_sim",), ("x",), (None,)], "_source_system string")
    assert conform.exclude_simulated(df).count() == 2


def test_views_reports_and_sink_order(spark):
    c = Chain(spark, SMALL)
    c.register_views(["panel"])
    assert spark.sql("SELECT count(*) FROM panel").first()[0] == c.panel.count()
    rep = daily_report(c)
    assert set(rep) == {"daily_series", "top_channel_stack", "share_divergence", "attribution_roas", "promo_days"}
    brief = channel_brief(c, "meta_cpas")
    assert {r["channel"] for r in rows(brief["period_compare"])} <= {"meta_cpas"}
    ordered = [r["priority"] for r in metrics.by_priority(c.taxonomy).collect()]
    assert ordered == sorted(ordered)
    first = metrics.sink_order(c.scan).select("date_local").first()[0]
    assert first == c.scan.agg(F.min("date_local")).first()[0]


def test_landing_files_and_replay(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "TH", "a"), (dt.date(2024, 1, 1), "TH", "b"), (None, "ID", "c"),
                                (dt.date(2024, 1, 2), None, "d")], "Date date, _market string, Campaign_id string")
    assert io.write_landing(df, str(tmp_path), "src") == 4
    files = {str(f.relative_to(tmp_path)): len(f.read_text().splitlines()) for f in tmp_path.rglob("*.ndjson")}
    assert sum(files.values()) == 4
    assert {f.split("/")[1] + "/" + f.split("/")[2].split(".")[0] for f in files} == {"TH/2024-01-01", "ID/unknown", "unknown/2024-01-02"}
    back = io.replay_landing(spark, str(tmp_path), "src", df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    # A day written again replaces its files.
    io.write_landing(df.where("Campaign_id = 'd'"), str(tmp_path), "src")
    assert io.replay_landing(spark, str(tmp_path), "src", df.schema).count() == 4
    odd = spark.createDataFrame([(dt.date(2024, 1, 1), "a/b:c", "x")], df.schema)
    io.write_landing(odd.withColumn("_market", F.lit("a:b")), str(tmp_path), "odd")
    assert [r["_market"] for r in rows(io.replay_landing(spark, str(tmp_path), "odd", df.schema))] == ["a:b"]


def _snapshot(df):
    return sorted((tuple(r) for r in df.select(sorted(c for c in df.columns if c not in ("traffic_source_mix", "event_kinds"))).collect()),
                  key=str)


def _close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert [v for v in x if not isinstance(v, float)] == [v for v in y if not isinstance(v, float)]
        assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], rel=1e-9)


def test_daily_refresh_reproduces_full_build(spark, tmp_path):
    """Land bronze, build everything, then refresh from the same bronze: facts
    and marts are unchanged at their published paths, and so is the session."""
    c = Chain(spark, SMALL, cache_marts=False)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    c.land_bronze(str(tmp_path))
    paths = c.materialize(str(tmp_path))
    before = {n: _snapshot(spark.read.parquet(p)) for n, p in paths.items()}
    out = c.refresh(paths, refresh_days=21)
    for n, p in paths.items():
        _close(_snapshot(spark.read.parquet(p)), before[n])
    _close(_snapshot(out.panel), before["panel"])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_daily_refresh_upserts(spark, tmp_path):
    """A second load with one campaign gone and others restated: keys that
    vanished stay, restated ones change, the panel at its path follows, and
    days before the window are not touched. ``replace_from`` drops the gone."""
    c = Chain(spark, SMALL, cache_marts=False)
    c.land_bronze(str(tmp_path / "b"))
    paths = c.materialize(str(tmp_path / "t"))
    gone, raw = "cmp-3", c.raw["meta_cpas_daily"]
    second = raw.withColumn("Spend", (F.col("Spend") * 2).cast("decimal(18,4)")).where(F.col("Campaign_id") != gone)
    before = spark.read.parquet(paths["fact_offplatform_ads"]).where("platform = 'meta_cpas'")
    before = {tuple(r[k] for k in ("date_local", "market", "campaign_id", "ad_set_or_ad_group_id")): float(r["spend_local"])
              for r in before.collect()}
    panel_before = {(r["date_local"], r["market"]): r["spend_usd"] for r in spark.read.parquet(paths["panel"]).where("channel = 'meta_cpas'").collect()}
    c.raw = c.raw.with_feeds(meta_cpas_daily=second)
    lo = c.p.as_of - dt.timedelta(days=21)

    def facts_now():
        df = spark.read.parquet(paths["fact_offplatform_ads"]).where("platform = 'meta_cpas'")
        return {tuple(r[k] for k in ("date_local", "market", "campaign_id", "ad_set_or_ad_group_id")): float(r["spend_local"])
                for r in df.collect()}
    c.refresh(paths, refresh_days=21)
    after = facts_now()
    assert after.keys() == before.keys() and any(k[2] == gone and k[0] >= lo for k in after)
    for k, v in after.items():
        assert v == pytest.approx(before[k] * (2 if k[0] >= lo and k[2] != gone else 1))
    panel = {(r["date_local"], r["market"]): r["spend_usd"] for r in spark.read.parquet(paths["panel"]).where("channel = 'meta_cpas'").collect()}
    assert panel.keys() == panel_before.keys()
    assert all(panel[k] == pytest.approx(panel_before[k]) for k in panel if k[0] < lo)
    assert any(panel[k] > 1.5 * panel_before[k] for k in panel if k[0] >= lo and panel_before[k])
    c.refresh(paths, refresh_days=21, replace_from=lo)
    assert not [k for k in facts_now() if k[2] == gone and k[0] >= lo]


def test_conversion_feeds_have_their_own_window(spark, tmp_path):
    from dataclasses import replace
    c = Chain(spark, SMALL, cache_marts=False)
    c.land_bronze(str(tmp_path))
    whole = c.fact_evc.agg(F.sum("conversions")).first()[0]
    short = Chain(spark, SMALL, replace(c.p, refresh_days=5, evc_refresh_days=365), cache_marts=False)
    short.raw = c.raw
    assert short.fact_evc.agg(F.sum("conversions")).first()[0] == whole


def test_landing_derives_each_base_once(spark, tmp_path):
    """Nine feeds from two bases: each raw table is scanned in one plan only."""
    c = Chain(spark, SMALL, cache_marts=False)
    base = bind.order_base(spark, SMALL).persist()
    try:
        for build in (bind.shopee_orders, bind.tiktok_shop_orders):
            plan = build(spark, SMALL, base)._jdf.queryExecution().optimizedPlan().toString()
            assert "InMemoryRelation" in plan
    finally:
        base.unpersist()
    paths = c.land_bronze(str(tmp_path))
    assert sorted(paths) == sorted(bind.RAW_BUILDERS)
    fresh = bind.Bronze(spark, SMALL)
    for n in ("shopee_orders", "evc_meta"):
        assert spark.read.parquet(paths[n]).count() == fresh[n].count()


def test_panel_traffic_split_channels(spark):
    """Optional live / video organic rows from the traffic mix."""
    from mediapanel.operators.panel import daily_channel_panel
    c = Chain(spark, SMALL, cache_marts=False)
    base = daily_channel_panel(c.fact_platform_sales, c.fact_onplatform_ads, c.fact_offplatform_ads, c.calendar)
    split = daily_channel_panel(c.fact_platform_sales, c.fact_onplatform_ads, c.fact_offplatform_ads, c.calendar,
                                traffic_split=True)
    extra = split.where(F.col("channel").isin("tiktok_shop_live", "tiktok_shop_video"))
    assert base.where(F.col("channel").isin("tiktok_shop_live", "tiktok_shop_video")).count() == 0
    assert extra.count() > 0 and split.count() == base.count() + extra.count()
    assert extra.where("spend_usd <> 0 OR platform <> 'tiktok_shop'").count() == 0


def test_a_day_landed_again_replaces_all_of_its_files(spark, tmp_path):
    schema = schemas.SHOPEE_ADS_DAILY
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in ("Date", "_market", "Campaign_id")]
    def rows(n, day):
        return spark.range(n).repartition(3).select(
            F.lit(day).cast("date").alias("Date"), F.lit("ID").alias("_market"), F.col("id").cast("string").alias("Campaign_id"),
            *cols).select(*schema.names)
    root = str(tmp_path)
    io.write_landing(rows(30, "2024-01-01").union(rows(5, "2024-01-02")), root, "shopee_ads")
    # Files of a day that several tasks wrote.
    first = next((tmp_path / "shopee_ads" / "ID").glob("2024-01-01.ndjson"))
    for i in (1, 2):
        first.with_name(f"2024-01-01.{i}.ndjson").write_text(first.read_text())
    assert io.replay_landing(spark, root, "shopee_ads", schema).count() == 95
    assert io.write_landing(rows(1, "2024-01-01"), root, "shopee_ads") == 1
    got = io.replay_landing(spark, root, "shopee_ads", schema).groupBy("Date").count().collect()
    assert {(str(r["Date"]), r["count"]) for r in got} == {("2024-01-01", 1), ("2024-01-02", 5)}
