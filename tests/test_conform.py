"""Staging operators on hand-written raw rows (PF1-PF8, W1-W3, D1-D3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from mediapanel.functions import exprs as X
from mediapanel.operators import conform
from mediapanel.sources import schemas, seeds

from .conftest import rows

TS = dt.datetime


def _raw(spark, schema, recs):
    names = [f.name for f in schema.fields]
    full = [tuple(r.get(n) for n in names) for r in recs]
    return spark.createDataFrame(full, schema)


def test_local_date_rolls_to_next_day_and_unknown_market_is_null(spark):
    df = spark.createDataFrame([(TS(2024, 1, 5, 18, 0), "Asia/Bangkok"), (TS(2024, 1, 5, 16, 59), "Asia/Bangkok"),
                                (TS(2024, 1, 5, 18, 0), None)], "ts timestamp, tz string")
    out = [r[0] for r in df.select(X.local_date("ts", "tz")).collect()]
    assert out == [dt.date(2024, 1, 6), dt.date(2024, 1, 5), None]


@pytest.mark.parametrize("d,week", [(dt.date(2024, 1, 1), 1), (dt.date(2023, 1, 1), 0), (dt.date(2023, 1, 2), 1),
                                    (dt.date(2024, 12, 31), 53), (dt.date(2021, 1, 3), 0)])
def test_week_of_year_is_monday_based(spark, d, week):
    assert spark.createDataFrame([(d,)], "d date").select(X.week_monday("d")).first()[0] == week
    assert int(d.strftime("%W")) == week


def test_ad_type_first_match_and_working_spend(spark):
    df = spark.createDataFrame([("VIDEO_LIVE",), ("Live shopping",), ("CATALOG_SEARCH",), ("search",), ("x",)],
                               "o string")
    assert [r[0] for r in df.select(X.ad_type_from_objective("o")).collect()] == \
        ["video", "live", "catalog", "search", "other"]
    s = spark.createDataFrame([(Decimal("10"), Decimal("3")), (Decimal("2"), Decimal("5")), (None, None)],
                              "s decimal(18,4), v decimal(18,4)")
    assert [float(r[0]) for r in s.select(X.working_spend("s", "v")).collect()] == [7.0, 0.0, 0.0]


def test_sales_dedup_latest_wins_with_ties_and_market_fallback(spark):
    dm, tm = seeds.dim_market(spark), seeds.traffic_source_map(spark)
    base = dict(Order_sn="A", Sku="S1", Item_id="i1", Shop_id="sh", Country="TH", Currency="THB",
                Create_time=TS(2024, 1, 5, 18, 0), Quantity=1, Traffic_source="Feed")
    so = _raw(spark, schemas.SHOPEE_ORDERS, [
        {**base, "Order_status": "COMPLETED", "Merchandise_subtotal": Decimal("10"),
         "ingested_at": TS(2024, 1, 6)},
        {**base, "Order_status": "CANCELLED", "Merchandise_subtotal": Decimal("12"),
         "ingested_at": TS(2024, 1, 7)},
        # same ingest time: the tie-break (item id desc) decides deterministically
        {**base, "Sku": "S2", "Item_id": "i1", "Order_status": "SHIPPED", "Merchandise_subtotal": Decimal("1"),
         "ingested_at": TS(2024, 1, 7)},
        {**base, "Sku": "S2", "Item_id": "i9", "Order_status": "SHIPPED", "Merchandise_subtotal": Decimal("2"),
         "ingested_at": TS(2024, 1, 7)},
    ])
    tt = _raw(spark, schemas.TIKTOK_SHOP_ORDERS, [
        dict(Order_id="T", Sku_id="S", Product_id="p", Shop_id="sh", Buyer_country="ZZ", Currency="USD",
             Order_create_time=TS(2024, 1, 5), Quantity=1, Order_amount=Decimal("5"), Order_source="LIVE",
             Order_status="Canceled", ingested_at=TS(2024, 1, 6), _market=None)])
    out = rows(conform.stg_platform_sales(so, tt, dm, tm), ["platform", "order_id", "sku_id"])
    a1, a2, t = out
    assert (a1["order_status"], a1["is_cancelled"], a1["traffic_source"]) == ("cancelled", True, "organic")
    assert a1["date_local"] == dt.date(2024, 1, 6)            # 18:00 UTC is the next day in Bangkok
    assert a2["item_id"] == "i9" and float(a2["gmv_local"]) == 2.0
    assert t["market"] == "ZZ" and t["date_local"] is None and t["traffic_source"] == "live"


def test_onplatform_dedup_keeps_sibling_ads_and_null_keys(spark):
    fx = seeds.fx_rates(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    rec = dict(Date=dt.date(2024, 1, 1), Campaign_id="c", Ad_group_id=None, Country_code="TH", Currency="THB",
               Objective_type="VIDEO", Impressions=1, Clicks=1, Complete_payment=0,
               Complete_payment_value=Decimal("0"), ingested_at=TS(2024, 1, 2))
    tt = _raw(spark, schemas.TIKTOK_ADS_DAILY, [
        {**rec, "Ad_id": "a1", "Spend": Decimal("36")}, {**rec, "Ad_id": "a2", "Spend": Decimal("72")},
        {**rec, "Ad_id": "a2", "Spend": Decimal("1"), "ingested_at": TS(2024, 1, 1)}])
    sh = _raw(spark, schemas.SHOPEE_ADS_DAILY, [])
    out = conform.stg_onplatform_ads(tt, sh, fx)
    assert sorted(float(r.spend_usd) for r in out.collect()) == [1.0, 2.0]   # sibling ad kept (D1)
    compat = conform.stg_onplatform_ads(tt, sh, fx, compat=True)
    assert compat.count() == 1                                               # reference keys drop a sibling


def test_offplatform_filters_and_rounding(spark):
    fx = seeds.fx_rates(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    g = dict(Date=dt.date(2024, 1, 1), Customer_id="cu", Campaign_id="c", Ad_group_id="g", Country="SG",
             Currency="SGD", Spend=Decimal("1.33"), ingested_at=TS(2024, 1, 2))
    google = _raw(spark, schemas.GOOGLE_ADS_SHOPEE_DAILY, [
        {**g, "Keyword": "k1", "Final_url": "https://shopee.sg/x", "Conversions": 1.5},
        {**g, "Keyword": "k2", "Final_url": "https://x.com", "Campaign_name": "SHP_brand", "Conversions": 2.5},
        {**g, "Keyword": "k3", "Final_url": "https://x.com", "Campaign_name": "brand", "Conversions": 1.0},
    ])
    meta = _raw(spark, schemas.META_CPAS_DAILY, [
        dict(Date=dt.date(2024, 1, 1), Campaign_id="m", Adset_id="a", Ad_id="x", Objective="CONVERSIONS",
             Currency="SGD", Spend=Decimal("1"), ingested_at=TS(2024, 1, 2))])
    out = rows(conform.stg_offplatform_ads(meta, google, fx), ["ad_key"])
    assert [r["ad_key"] for r in out] == ["k1", "k2"]                       # regex URL or SHP_ prefix
    assert [r["purchases_reported"] for r in out] == [2, 3]                  # half away from zero
    assert out[0]["spend_usd"] == pytest.approx(1.0)


def test_missing_fx_rate_gives_null_usd(spark):
    df = spark.createDataFrame([(Decimal("10"), None), (Decimal("10"), Decimal("0"))],
                               "a decimal(18,4), r decimal(12,6)")
    assert [r[0] for r in df.select(X.usd("a", "r")).collect()] == [None, None]


def test_evc_buckets(spark):
    g = spark.createDataFrame([(dt.date(2024, 1, 1), "TH", "engaged_view", 2.0, Decimal("5"), 9.0, Decimal("9"), "s"),
                               (dt.date(2024, 1, 1), "TH", "click_through", 3.0, Decimal("6"), 4.0, Decimal("7"), "s")],
                              "date date, _market string, ad_event_type string, conversions double, "
                              "conversions_value decimal(18,4), all_conversions double, "
                              "all_conversions_value decimal(18,4), _source_system string")
    m = spark.createDataFrame([(dt.date(2024, 1, 1), "TH", "1d_view", "purchase", 1, Decimal("1"), "s")],
                              "date date, _market string, attribution_window string, action_type string, "
                              "action_count bigint, action_value decimal(18,4), _source_system string")
    t = spark.createDataFrame([], "date date, _market string, attribution_type string, conversions bigint, "
                                  "conversion_value decimal(18,4), _source_system string")
    out = {(r.channel, r.attribution_bucket): r.conversions for r in conform.stg_evc(g, m, t).collect()}
    assert out == {("google_ads_shopee", "evc"): 2.0, ("google_ads_shopee", "click"): 3.0,
                   ("meta_cpas", "evc"): 1.0}
    compat = {(r.channel, r.attribution_bucket): r.conversions for r in conform.stg_evc(g, m, t, True).collect()}
    assert compat[("google_ads_shopee", "click")] == 4.0 and compat[("meta_cpas", "click")] == 1.0
