"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Spark builders take a ``Chain`` and return a DataFrame; every computed column
is aliased and money is returned as double rounded to 4 decimals, identically
in the oracle, so the two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from .chain import Chain

QUERIES: dict[str, Callable[[Chain], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn
    return deco


def r4(c, alias: str | None = None):
    """Round to 4 decimals through decimal(38,10): both engines then round the
    same decimal half away from zero, so exact ties agree."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double").cast("decimal(38,10)"), 4).cast("double").alias(alias or c)


def ts_str(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _r4(c, alias=None):
    return f"cast(round(cast(cast({c} AS double) AS decimal(38,10)), 4) AS double) AS {alias or c}"


def _ts(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


# ----------------------------------------------------------------- silver
@register("stg_platform_sales", O.sql(f"""
SELECT platform, market, shop_id, sku_id, item_id, order_id, order_status, date_local,
  {_ts('create_time_utc')}, quantity, {_r4('gmv_local')}, currency, traffic_source, is_cancelled,
  is_completed, {_ts('ingested_at')}
FROM stg_platform_sales""", "stg_platform_sales"))
def q_stg_platform_sales(c: Chain) -> DataFrame:
    s = c.stg_platform_sales
    return s.select("platform", "market", "shop_id", "sku_id", "item_id", "order_id", "order_status",
                    "date_local", ts_str("create_time_utc"), "quantity", r4("gmv_local"), "currency",
                    "traffic_source", "is_cancelled", "is_completed", ts_str("ingested_at"))


@register("stg_onplatform_ads", O.sql(f"""
SELECT platform, market, ad_type, objective, campaign_id, ad_group_id, sku_id, ad_key, currency,
  {_r4('spend_local')}, {_r4('spend_usd')}, impressions, clicks, video_views_2s_or_6s, direct_orders,
  broad_orders, {_r4('direct_gmv_local')}, {_r4('broad_gmv_local')}, {_r4('direct_gmv_usd')},
  {_r4('broad_gmv_usd')}, attribution_window, date_local, {_ts('ingested_at')}
FROM stg_onplatform_ads""", "stg_onplatform_ads"))
def q_stg_onplatform_ads(c: Chain) -> DataFrame:
    s = c.stg_onplatform_ads
    return s.select("platform", "market", "ad_type", "objective", "campaign_id", "ad_group_id", "sku_id",
                    "ad_key", "currency", r4("spend_local"), r4("spend_usd"), "impressions", "clicks",
                    "video_views_2s_or_6s", "direct_orders", "broad_orders", r4("direct_gmv_local"),
                    r4("broad_gmv_local"), r4("direct_gmv_usd"), r4("broad_gmv_usd"),
                    "attribution_window", "date_local", ts_str("ingested_at"))


@register("stg_offplatform_ads", O.sql(f"""
SELECT platform, market, destination_platform, campaign_id, ad_set_or_ad_group_id, campaign_type,
  catalog_id, ad_key, currency, {_r4('spend_local')}, {_r4('spend_usd')}, impressions, clicks,
  add_to_cart, purchases_reported, {_r4('purchase_value_reported_local')},
  {_r4('purchase_value_reported_usd')}, attribution_window, date_local, {_ts('ingested_at')}
FROM stg_offplatform_ads""", "stg_offplatform_ads"))
def q_stg_offplatform_ads(c: Chain) -> DataFrame:
    s = c.stg_offplatform_ads
    return s.select("platform", "market", "destination_platform", "campaign_id", "ad_set_or_ad_group_id",
                    "campaign_type", "catalog_id", "ad_key", "currency", r4("spend_local"), r4("spend_usd"),
                    "impressions", "clicks", "add_to_cart", "purchases_reported",
                    r4("purchase_value_reported_local"), r4("purchase_value_reported_usd"),
                    "attribution_window", "date_local", ts_str("ingested_at"))


@register("stg_evc", O.sql(f"""
SELECT date_local, market, channel, attribution_bucket, {_r4('conversions')},
  {_r4('conversion_value_local')}, _source_system
FROM stg_evc""", "stg_evc"))
def q_stg_evc(c: Chain) -> DataFrame:
    return c.stg_evc.select("date_local", "market", "channel", "attribution_bucket", r4("conversions"),
                            r4("conversion_value_local"), "_source_system")


# ----------------------------------------------------------------- gold
@register("fact_platform_sales", O.sql(f"""
SELECT date_local, market, platform, shop_id, sku_id, orders_gross, orders_cancelled, orders_net,
  {_r4('gmv_gross_local')}, {_r4('gmv_net_local')}, {_r4('gmv_net_usd')}, currency
FROM fact_platform_sales""", "fact_platform_sales"))
def q_fact_platform_sales(c: Chain) -> DataFrame:
    f = c.fact_platform_sales
    return f.select("date_local", "market", "platform", "shop_id", "sku_id", "orders_gross",
                    "orders_cancelled", "orders_net", r4("gmv_gross_local"), r4("gmv_net_local"),
                    r4("gmv_net_usd"), "currency")


@register("traffic_mix", O.sql("""
SELECT date_local, market, platform, shop_id, sku_id, traffic_source_mix
FROM fact_platform_sales""", "fact_platform_sales"))
def q_traffic_mix(c: Chain) -> DataFrame:
    f = c.fact_platform_sales
    return f.select("date_local", "market", "platform", "shop_id", "sku_id",
                    F.to_json("traffic_source_mix", {"ignoreNullFields": "false"}).alias("traffic_source_mix"))


@register("fact_onplatform_ads", O.sql(f"""
SELECT date_local, market, platform, ad_type, objective, campaign_id, ad_group_id, sku_id,
  {_r4('spend_local')}, {_r4('spend_usd')}, impressions, clicks, video_views_2s_or_6s, direct_orders,
  broad_orders, {_r4('direct_gmv_local')}, {_r4('broad_gmv_local')}, {_r4('direct_gmv_usd')},
  {_r4('broad_gmv_usd')}, attribution_window, currency
FROM fact_onplatform_ads""", "fact_onplatform_ads"))
def q_fact_onplatform_ads(c: Chain) -> DataFrame:
    f = c.fact_onplatform_ads
    return f.select("date_local", "market", "platform", "ad_type", "objective", "campaign_id", "ad_group_id",
                    "sku_id", r4("spend_local"), r4("spend_usd"), "impressions", "clicks",
                    "video_views_2s_or_6s", "direct_orders", "broad_orders", r4("direct_gmv_local"),
                    r4("broad_gmv_local"), r4("direct_gmv_usd"), r4("broad_gmv_usd"),
                    "attribution_window", "currency")


@register("fact_offplatform_ads", O.sql(f"""
SELECT date_local, market, platform, destination_platform, campaign_id, ad_set_or_ad_group_id,
  campaign_type, catalog_id, {_r4('spend_local')}, {_r4('spend_usd')}, impressions, clicks, add_to_cart,
  purchases_reported, {_r4('purchase_value_reported_local')}, {_r4('purchase_value_reported_usd')},
  attribution_window, currency
FROM fact_offplatform_ads""", "fact_offplatform_ads"))
def q_fact_offplatform_ads(c: Chain) -> DataFrame:
    f = c.fact_offplatform_ads
    return f.select("date_local", "market", "platform", "destination_platform", "campaign_id",
                    "ad_set_or_ad_group_id", "campaign_type", "catalog_id", r4("spend_local"),
                    r4("spend_usd"), "impressions", "clicks", "add_to_cart", "purchases_reported",
                    r4("purchase_value_reported_local"), r4("purchase_value_reported_usd"),
                    "attribution_window", "currency")


@register("fact_evc", O.sql(f"""
SELECT date_local, market, channel, attribution_bucket, {_r4('conversions')},
  {_r4('conversion_value_local')}, {_r4('conversion_value_usd')}, currency
FROM fact_evc""", "fact_evc"))
def q_fact_evc(c: Chain) -> DataFrame:
    return c.fact_evc.select("date_local", "market", "channel", "attribution_bucket", r4("conversions"),
                             r4("conversion_value_local"), r4("conversion_value_usd"), "currency")


@register("platform_totals", O.sql(f"""
SELECT date_local, market, platform, platform_total_orders, {_r4('platform_total_gmv_usd')}
FROM platform_totals""", "platform_totals"))
def q_platform_totals(c: Chain) -> DataFrame:
    from ..operators.panel import platform_totals
    return platform_totals(c.fact_platform_sales).select(
        "date_local", "market", "platform", "platform_total_orders", r4("platform_total_gmv_usd"))


PANEL_OUT = ["date_local", "market", "channel", "platform", "spend_usd", "impressions", "clicks",
             "ads_attributed_orders", "ads_attributed_gmv_usd", "direct_gmv_usd", "broad_gmv_usd",
             "platform_total_orders", "platform_total_gmv_usd", "is_weekend", "is_payday", "is_mega_sale",
             "week_of_year"]
PANEL_MONEY = {"spend_usd", "ads_attributed_gmv_usd", "direct_gmv_usd", "broad_gmv_usd",
               "platform_total_gmv_usd"}


@register("daily_channel_panel", O.sql("SELECT " + ", ".join(
    _r4(c) if c in PANEL_MONEY else c for c in PANEL_OUT) + " FROM panel", "panel"))
def q_daily_channel_panel(c: Chain) -> DataFrame:
    return c.panel.select(*[r4(x) if x in PANEL_MONEY else x for x in PANEL_OUT])


EVC_OUT = PANEL_OUT[:9] + ["reported_gmv_usd", "direct_gmv_usd", "broad_gmv_usd", "evc_gmv_usd",
                           "all_gmv_usd", "reported_conversions", "evc_conversions", "all_conversions"] \
    + PANEL_OUT[11:]
EVC_MONEY = PANEL_MONEY | {"reported_gmv_usd", "evc_gmv_usd", "all_gmv_usd", "reported_conversions",
                           "evc_conversions", "all_conversions"}


@register("panel_evc", O.sql("SELECT " + ", ".join(
    _r4(c) if c in EVC_MONEY else c for c in EVC_OUT) + " FROM panel_evc", "panel_evc"))
def q_panel_evc(c: Chain) -> DataFrame:
    return c.panel_evc.select(*[r4(x) if x in EVC_MONEY else x for x in EVC_OUT])


# Analytics registrations live in their own module.
from . import registry_analytics  # noqa: E402,F401
from . import registry_decisions  # noqa: E402,F401
from . import registry_response  # noqa: E402,F401
from . import registry_misc  # noqa: E402,F401
from . import registry_more  # noqa: E402,F401
