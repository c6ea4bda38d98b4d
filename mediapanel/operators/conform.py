"""Silver layer: conform raw feeds to one schema per stream, de-duplicate
(latest ingest wins), derive local dates and USD amounts.

PF1-PF8, PF16, J1-J3, U1, W1-W3.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources import seeds


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the latest version per key.

    ``order`` names a total order (ingested_at, then tie-breakers, D2; the
    largest wins, nulls last) so the survivor is deterministic. Spark plans this as a partial
    ``WindowGroupLimit`` before the shuffle and a final one after it, so a hot
    key sends at most one row per map partition across the network. ``keys``
    should name the most distinct column first; the sort compares by its prefix.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


Dedup = Callable[[DataFrame, list[str], list[str]], DataFrame]


def deciding(order: list[str], keys: list[str], columns: list[str]) -> list[str]:
    """The part of ``order`` that decides ``columns`` of the survivor: rows of a
    key that agree up to the last of them agree in all of them, so whichever of
    these rows a later tie-breaker prefers, ``columns`` are the same."""
    assert set(columns) <= {*keys, *order}
    return order[:max((i + 1 for i, c in enumerate(order) if c in columns), default=1)]


def _traffic_join(df: DataFrame, ts_map: DataFrame, platform: str, raw: Column) -> DataFrame:
    """Left join on (constant platform, key) against the broadcast map."""
    m = ts_map.where(F.col("platform") == platform).select(
        F.col("raw_value").alias("_ts_raw"), F.col("canonical").alias("_ts_canon"))
    return df.join(F.broadcast(m), raw == F.col("_ts_raw"), "left")


def exclude_simulated(df: DataFrame) -> DataFrame:
    """PF16: drop rows whose source system ends with ``_sim``."""
    return df.where(~F.coalesce(F.col("_source_system"), F.lit("")).endswith("_sim"))


# What the sales fact reads of the staged order lines.
FACT_COLUMNS = ["date_local", "is_cancelled", "platform", "market", "currency", "traffic_source", "sku_id", "shop_id",
                "gmv_local", "ingested_at"]


def stg_platform_sales(shopee_orders: DataFrame, tiktok_orders: DataFrame, dim_market: DataFrame,
                       traffic_map: DataFrame, since: dt.date | None = None, dedup: Dedup = latest_wins,
                       fact: bool = False) -> DataFrame:
    """PF1-PF3 + J1 + U1 + W1 + J2: one de-duplicated order-line stream.

    ``since``: when only a trailing window is refreshed, order lines created
    more than a day before it cannot land in it (the +14 h maximum zone offset),
    so they are dropped before the shuffle of the dedup (valid while the create
    time of a key never changes).

    ``fact``: only the columns of ``FACT_COLUMNS``; tie-breakers that cannot
    change them are not moved through the dedup's shuffle.
    """
    so = _traffic_join(shopee_orders, traffic_map, "shopee", F.lower("Traffic_source"))
    shopee = so.select(
        F.lit("shopee").alias("platform"),
        F.coalesce("_market", "Country").alias("market"),
        F.col("Shop_id").alias("shop_id"),
        F.col("Sku").alias("sku_id"),
        F.col("Item_id").alias("item_id"),
        F.col("Order_sn").alias("order_id"),
        F.lower("Order_status").alias("order_status"),
        F.col("Create_time").alias("create_time_utc"),
        F.col("Pay_time").alias("pay_time_utc"),
        F.col("Complete_time").alias("complete_time_utc"),
        F.col("Quantity").alias("quantity"),
        F.col("Merchandise_subtotal").alias("gmv_local"),
        F.col("Currency").alias("currency"),
        F.coalesce("_ts_canon", F.lower("Traffic_source")).alias("traffic_source"),
        "ingested_at",
    )
    to = _traffic_join(tiktok_orders, traffic_map, "tiktok_shop", F.col("Order_source"))
    tiktok = to.select(
        F.lit("tiktok_shop").alias("platform"),
        F.coalesce("_market", "Buyer_country").alias("market"),
        F.col("Shop_id").alias("shop_id"),
        F.col("Sku_id").alias("sku_id"),
        F.col("Product_id").alias("item_id"),
        F.col("Order_id").alias("order_id"),
        F.lower("Order_status").alias("order_status"),
        F.col("Order_create_time").alias("create_time_utc"),
        F.col("Payment_time").alias("pay_time_utc"),
        F.lit(None).cast("timestamp").alias("complete_time_utc"),
        F.col("Quantity").alias("quantity"),
        F.col("Order_amount").alias("gmv_local"),
        F.col("Currency").alias("currency"),
        F.coalesce("_ts_canon", F.lower("Order_source")).alias("traffic_source"),
        "ingested_at",
    )
    u = shopee.unionByName(tiktok)
    if since is not None:
        u = u.where(F.col("create_time_utc") >= F.lit(since - dt.timedelta(days=1)).cast("timestamp"))
    order = ["ingested_at", "item_id", "shop_id", "gmv_local", "quantity", "order_status",
             "traffic_source", "create_time_utc", "market", "currency", "pay_time_utc", "complete_time_utc"]
    keys = ["order_id", "sku_id", "platform"]
    if fact:
        order = deciding(order, keys, ["platform", "market", "shop_id", "sku_id", "create_time_utc", "gmv_local", "currency",
                                       "traffic_source", "order_status", "ingested_at"])
        # Attributes of few values side by side: the shuffle compresses them as one.
        few = ["platform", "market", "currency", "order_status", "traffic_source"]
        u = u.select("order_id", "sku_id", *few, *[c for c in reversed(order) if c not in few])
    d = dedup(u, keys, order)
    d = d.join(F.broadcast(dim_market.select("market", "timezone")), "market", "left")
    if fact:
        return d.withColumn("date_local", X.local_date("create_time_utc", "timezone")).withColumn(
            "is_cancelled", X.cancelled_flag("order_status")).select(*FACT_COLUMNS)
    return d.select(
        "platform", "market", "shop_id", "sku_id", "item_id", "order_id", "order_status",
        X.local_date("create_time_utc", "timezone").alias("date_local"),
        "create_time_utc", "pay_time_utc", "complete_time_utc", "quantity", "gmv_local",
        "currency", "traffic_source",
        X.cancelled_flag("order_status").alias("is_cancelled"),
        X.completed_flag("order_status").alias("is_completed"),
        "ingested_at",
    )


def _fx_join(df: DataFrame, fx: DataFrame, date_col: str, cur_col: str = "currency") -> DataFrame:
    """Left join the (date, currency) FX table. The table is bounded by
    calendar days x currencies, so it is broadcast."""
    f = fx.select(F.col("date").alias("_fx_date"), F.col("currency").alias("_fx_cur"), "usd_rate")
    return df.join(F.broadcast(f), (F.col(date_col) == F.col("_fx_date")) & (F.col(cur_col) == F.col("_fx_cur")),
                   "left").drop("_fx_date", "_fx_cur")


def stg_onplatform_ads(tiktok_ads: DataFrame, shopee_ads: DataFrame, fx: DataFrame,
                       compat: bool = False, dedup: Dedup = latest_wins) -> DataFrame:
    """PF4-PF6, PF8, W2: TikTok Ads + Shopee Ads daily rows in one stream.

    Dedup keys are the feeds' natural keys (D1): the ad (TikTok) or keyword
    (Shopee) is kept as ``ad_key``; ``compat`` drops it like the reference.
    """
    tt = tiktok_ads.select(
        F.lit("tiktok_ads").alias("platform"),
        F.coalesce("_market", "Country_code").alias("market"),
        X.ad_type_from_objective("Objective_type").alias("ad_type"),
        F.col("Objective_type").alias("objective"),
        F.col("Campaign_id").alias("campaign_id"),
        F.col("Ad_group_id").alias("ad_group_id"),
        F.lit(None).cast("string").alias("sku_id"),
        F.col("Ad_id").alias("ad_key"),
        F.col("Currency").alias("currency"),
        F.col("Spend").alias("spend_local"),
        F.col("Impressions").alias("impressions"),
        F.col("Clicks").alias("clicks"),
        F.col("Video_play_6s").alias("video_views_2s_or_6s"),
        F.col("Complete_payment").alias("direct_orders"),
        F.lit(None).cast("long").alias("broad_orders"),
        F.col("Complete_payment_value").alias("direct_gmv_local"),
        F.lit(None).cast("decimal(18,4)").alias("broad_gmv_local"),
        F.col("Conversion_attribution_window").alias("attribution_window"),
        F.col("Date").alias("date_report"),
        "ingested_at",
    )
    sh = shopee_ads.select(
        F.lit("shopee_ads").alias("platform"),
        F.coalesce("_market", "Country").alias("market"),
        F.lower("Ad_type").alias("ad_type"),
        F.lit(None).cast("string").alias("objective"),
        F.col("Campaign_id").alias("campaign_id"),
        F.lit(None).cast("string").alias("ad_group_id"),
        F.col("Sku_id").alias("sku_id"),
        F.col("Keyword").alias("ad_key"),
        F.col("Currency").alias("currency"),
        X.working_spend("Spend", "Voucher_subsidy").cast("decimal(18,4)").alias("spend_local"),
        F.col("Impressions").alias("impressions"),
        F.col("Clicks").alias("clicks"),
        F.lit(None).cast("long").alias("video_views_2s_or_6s"),
        F.col("Direct_orders").alias("direct_orders"),
        F.col("Broad_orders").alias("broad_orders"),
        F.col("Direct_gmv").alias("direct_gmv_local"),
        F.col("Broad_gmv").alias("broad_gmv_local"),
        F.col("Attribution_window").alias("attribution_window"),
        F.col("Date").alias("date_report"),
        "ingested_at",
    )
    u = tt.unionByName(sh)
    keys = ["date_report", "campaign_id", "ad_group_id", "sku_id", "ad_type", "market", "platform"]
    if not compat:
        keys.insert(0, "ad_key")
    order = ["ingested_at", "spend_local", "impressions", "clicks", "direct_gmv_local",
             "broad_gmv_local", "direct_orders", "objective", "ad_key", "broad_orders",
             "video_views_2s_or_6s", "currency", "attribution_window"]
    d = _fx_join(dedup(u, keys, order), fx, "date_report")
    return d.select(
        "platform", "market", "ad_type", "objective", "campaign_id", "ad_group_id", "sku_id",
        "ad_key", "currency", "spend_local",
        X.usd("spend_local", "usd_rate").alias("spend_usd"),
        "impressions", "clicks", "video_views_2s_or_6s", "direct_orders", "broad_orders",
        "direct_gmv_local", "broad_gmv_local",
        X.usd("direct_gmv_local", "usd_rate").alias("direct_gmv_usd"),
        X.usd("broad_gmv_local", "usd_rate").alias("broad_gmv_usd"),
        "attribution_window",
        F.col("date_report").alias("date_local"),
        "ingested_at",
    )


SHOPEE_URL = seeds.SHOPEE_URL_PATTERN
SHOPEE_CAMPAIGN = seeds.SHOPEE_CAMPAIGN_PATTERN


def stg_offplatform_ads(meta: DataFrame, google: DataFrame, fx: DataFrame,
                        compat: bool = False, dedup: Dedup = latest_wins) -> DataFrame:
    """PF7, PF8, W3: Meta CPAS + Google Ads rows that land on the shop.

    Meta keeps catalog objectives; Google keeps shop-landing URLs or campaigns
    prefixed ``SHP_`` / ``SHP-`` (D3: a regex, which the reference's LIKE meant).
    Conversions are rounded half away from zero before the integer cast.
    """
    m = meta.where(F.upper("Objective").contains("CATALOG")).select(
        F.lit("meta_cpas").alias("platform"),
        F.coalesce("_market", "Country").alias("market"),
        F.lit("shopee").alias("destination_platform"),
        F.col("Campaign_id").alias("campaign_id"),
        F.col("Adset_id").alias("ad_set_or_ad_group_id"),
        F.lit("catalog_sales").alias("campaign_type"),
        F.col("Catalog_id").alias("catalog_id"),
        F.col("Ad_id").alias("ad_key"),
        F.col("Currency").alias("currency"),
        F.col("Spend").alias("spend_local"),
        F.col("Impressions").alias("impressions"),
        F.col("Link_clicks").alias("clicks"),
        F.col("Add_to_cart").alias("add_to_cart"),
        F.col("Purchase").alias("purchases_reported"),
        F.col("Purchase_value").alias("purchase_value_reported_local"),
        F.col("Attribution_window").alias("attribution_window"),
        F.col("Date").alias("date_report"),
        "ingested_at",
    )
    keep = (F.lower(F.coalesce("Final_url", F.lit(""))).rlike(SHOPEE_URL)
            | F.upper(F.coalesce("Campaign_name", F.lit(""))).rlike(SHOPEE_CAMPAIGN))
    g = google.where(keep).select(
        F.lit("google_ads_shopee").alias("platform"),
        F.coalesce("_market", "Country").alias("market"),
        F.lit("shopee").alias("destination_platform"),
        F.col("Campaign_id").alias("campaign_id"),
        F.col("Ad_group_id").alias("ad_set_or_ad_group_id"),
        F.col("Campaign_type").alias("campaign_type"),
        F.lit(None).cast("string").alias("catalog_id"),
        F.col("Keyword").alias("ad_key"),
        F.col("Currency").alias("currency"),
        F.col("Spend").alias("spend_local"),
        F.col("Impressions").alias("impressions"),
        F.col("Clicks").alias("clicks"),
        F.lit(None).cast("long").alias("add_to_cart"),
        F.round("Conversions").cast("long").alias("purchases_reported"),
        F.col("Conversion_value").alias("purchase_value_reported_local"),
        F.col("Attribution_model").alias("attribution_window"),
        F.col("Date").alias("date_report"),
        "ingested_at",
    )
    u = m.unionByName(g)
    keys = ["date_report", "campaign_id", "ad_set_or_ad_group_id", "market", "platform"]
    if not compat:
        keys.insert(0, "ad_key")
    order = ["ingested_at", "spend_local", "impressions", "clicks", "purchases_reported",
             "purchase_value_reported_local", "campaign_type", "catalog_id", "ad_key", "add_to_cart",
             "destination_platform", "currency", "attribution_window"]
    d = _fx_join(dedup(u, keys, order), fx, "date_report")
    return d.select(
        "platform", "market", "destination_platform", "campaign_id", "ad_set_or_ad_group_id",
        "campaign_type", "catalog_id", "ad_key", "currency", "spend_local",
        X.usd("spend_local", "usd_rate").alias("spend_usd"),
        "impressions", "clicks", "add_to_cart", "purchases_reported",
        "purchase_value_reported_local",
        X.usd("purchase_value_reported_local", "usd_rate").alias("purchase_value_reported_usd"),
        "attribution_window",
        F.col("date_report").alias("date_local"),
        "ingested_at",
    )


# PF10: conversion-kind -> attribution bucket per platform (default 'click').
EVC_BUCKETS = seeds.EVC_BUCKETS
EVC_BUCKETS_COMPAT = seeds.EVC_BUCKETS_COMPAT


def _bucket(kind: Column, mapping: dict) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, kind), F.lit("click"))


def stg_evc(evc_google: DataFrame, evc_meta: DataFrame, evc_tiktok: DataFrame,
            compat: bool = False) -> DataFrame:
    """A5 + PF10: conversion-API rows summed per (date, market, channel, bucket)."""
    return evc_totals(evc_rows(evc_google, evc_meta, evc_tiktok, compat))


def evc_rows(evc_google: DataFrame, evc_meta: DataFrame, evc_tiktok: DataFrame, compat: bool = False,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """PF10: the three conversion feeds in one shape, with the columns ``keep``.

    D12: click-through rows are summed on ``conversions`` (``all_conversions``
    already includes view-assisted ones); ``compat`` sums ``all_conversions``.
    """
    bm = EVC_BUCKETS_COMPAT if compat else EVC_BUCKETS
    conv, val = ("all_conversions", "all_conversions_value") if compat else ("conversions", "conversions_value")
    g = (evc_google.select(
            F.col("date").alias("date_local"), F.col("_market").alias("market"),
            F.lit("google_ads_shopee").alias("channel"),
            _bucket(F.col("ad_event_type"), bm["google_ads_shopee"]).alias("attribution_bucket"),
            F.col(conv).cast("double").alias("c"), F.col(val).alias("v"), "_source_system", *keep))
    m = (evc_meta.where(F.col("action_type") == "purchase").select(
            F.col("date").alias("date_local"), F.col("_market").alias("market"),
            F.lit("meta_cpas").alias("channel"),
            _bucket(F.col("attribution_window"), bm["meta_cpas"]).alias("attribution_bucket"),
            F.col("action_count").cast("double").alias("c"), F.col("action_value").alias("v"),
            "_source_system", *keep))
    t = (evc_tiktok.select(
            F.col("date").alias("date_local"), F.col("_market").alias("market"),
            F.lit("tiktok_ads").alias("channel"),
            _bucket(F.col("attribution_type"), bm["tiktok_ads"]).alias("attribution_bucket"),
            F.col("conversions").cast("double").alias("c"), F.col("conversion_value").alias("v"),
            "_source_system", *keep))
    return g.unionByName(m).unionByName(t)


def evc_totals(rows: DataFrame) -> DataFrame:
    """A5: one aggregation over the union, as the three sources share the
    output grain. The source system is constant per channel: grouped on (hash
    aggregate)."""
    return rows.groupBy("date_local", "market", "channel", "attribution_bucket", "_source_system").agg(
        F.sum("c").alias("conversions"),
        F.sum("v").alias("conversion_value_local"))
