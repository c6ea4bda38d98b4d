"""The daily channel panel (P4) and its EVC variant (P5).

Grain: date_local x market x channel. Inputs are the three facts; the output
is the table every analytics operator reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

PANEL_COLUMNS = ["date_local", "market", "channel", "platform", "spend_usd", "impressions", "clicks",
                 "ads_attributed_orders", "ads_attributed_gmv_usd", "direct_gmv_usd", "broad_gmv_usd",
                 "platform_total_orders", "platform_total_gmv_usd", "is_weekend", "is_payday",
                 "is_mega_sale", "week_of_year"]

SHOPEE_AD_CHANNELS = ["product_search", "shop_search", "targeting", "gmv_max", "affiliate"]


def platform_totals(fact_sales: DataFrame) -> DataFrame:
    """Net orders and net GMV per (date, market, platform)."""
    return fact_sales.groupBy("date_local", "market", "platform").agg(
        F.sum("orders_net").alias("platform_total_orders"),
        F.sum("gmv_net_usd").alias("platform_total_gmv_usd"))


def onplatform_channel(platform, ad_type):
    """PF11: (platform, ad_type) -> channel, '<platform>_other' fallback."""
    p, a = F.col(platform), F.col(ad_type)
    c = F.when(p == "tiktok_ads", F.lit("tiktok_ads"))
    for t in SHOPEE_AD_CHANNELS:
        c = c.when((p == "shopee_ads") & (a == t), F.lit(f"shopee_ads_{t}"))
    return c.otherwise(F.concat(p, F.lit("_other")))


def daily_channel_panel(fact_sales: DataFrame, fact_on: DataFrame, fact_off: DataFrame,
                        calendar: DataFrame, compat: bool = False, traffic_split: bool = False) -> DataFrame:
    """A7-A10 -> U1 -> J5/J6 -> PF12.

    Platform totals are computed once and serve both as the per-row totals
    (J5) and as the organic rows (A10: their keys are exactly the distinct
    (date, market, platform) of the sales fact). The organic rows bring their
    totals along, so both uses read the same columns and Spark runs the sales
    fact behind them once.
    """
    totals = platform_totals(fact_sales)
    on = fact_on
    if not compat:
        # direct = broad for paid channels that report one figure.
        on = on.withColumn("broad_gmv_usd", F.when(F.col("platform") == "tiktok_ads",
                           F.coalesce("broad_gmv_usd", "direct_gmv_usd")).otherwise(F.col("broad_gmv_usd")))
    onp = on.groupBy(
        "date_local", "market",
        onplatform_channel("platform", "ad_type").alias("channel"),
        F.when(F.col("platform") == "tiktok_ads", "tiktok_shop").otherwise("shopee").alias("anchor_platform"),
    ).agg(
        F.sum("spend_usd").alias("spend_usd"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum(F.coalesce("broad_orders", "direct_orders")).alias("ads_attributed_orders"),
        F.sum(F.coalesce("broad_gmv_usd", "direct_gmv_usd")).alias("ads_attributed_gmv_usd"),
        F.sum("direct_gmv_usd").alias("direct_gmv_usd"),
        F.sum("broad_gmv_usd").alias("broad_gmv_usd"),
    )
    offp = fact_off.groupBy(
        "date_local", "market", F.col("platform").alias("channel"),
        F.col("destination_platform").alias("anchor_platform"),
    ).agg(
        F.sum("spend_usd").alias("spend_usd"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("purchases_reported").alias("ads_attributed_orders"),
        F.sum("purchase_value_reported_usd").alias("ads_attributed_gmv_usd"),
        F.sum("purchase_value_reported_usd").alias("direct_gmv_usd"),
        F.sum("purchase_value_reported_usd").alias("broad_gmv_usd"),
    )
    org = totals.select(
        "date_local", "market",
        F.when(F.col("platform") == "shopee", "shopee_organic")
         .when(F.col("platform") == "tiktok_shop", "tiktok_shop_organic")
         .otherwise(F.concat("platform", F.lit("_organic"))).alias("channel"),
        F.col("platform").alias("anchor_platform"),
        F.lit(0.0).alias("spend_usd"),
        F.lit(None).cast("long").alias("impressions"),
        F.lit(None).cast("long").alias("clicks"),
        F.lit(None).cast("long").alias("ads_attributed_orders"),
        F.lit(None).cast("double").alias("ads_attributed_gmv_usd"),
        F.lit(None).cast("double").alias("direct_gmv_usd"),
        F.lit(None).cast("double").alias("broad_gmv_usd"),
        "platform_total_orders", "platform_total_gmv_usd",
    )
    u = onp.unionByName(offp)
    if traffic_split:
        # X3 (off by default): live / video organic channels of the TikTok
        # shop, GMV = platform GMV x the channel's share of order lines.
        from .features import traffic_split_organic
        ts = traffic_split_organic(fact_sales).select(
            "date_local", "market", "channel", F.lit("tiktok_shop").alias("anchor_platform"),
            F.lit(0.0).alias("spend_usd"), F.lit(None).cast("long").alias("impressions"),
            F.lit(None).cast("long").alias("clicks"), F.lit(None).cast("long").alias("ads_attributed_orders"),
            F.col("gmv_usd").alias("ads_attributed_gmv_usd"), F.lit(None).cast("double").alias("direct_gmv_usd"),
            F.lit(None).cast("double").alias("broad_gmv_usd"))
        u = u.unionByName(ts)
    # Totals per (date, market, platform) are bounded by days x markets x
    # platforms; AQE broadcasts them when small and keeps a shuffle join beyond.
    t = totals.withColumnRenamed("platform", "anchor_platform")
    p = u.join(t, ["date_local", "market", "anchor_platform"], "left").unionByName(org)
    # Distinct (date, market) of the calendar seed -> boolean, plus the
    # sorted event kinds of the day (D15). Bounded by calendar days x markets.
    mega = calendar.groupBy(F.col("date").alias("date_local"), "market").agg(
        F.sort_array(F.collect_set("event_kind")).alias("event_kinds")).withColumn("_mega", F.lit(True))
    p = p.join(F.broadcast(mega), ["date_local", "market"], "left")
    return p.select(
        "date_local", "market", "channel", F.col("anchor_platform").alias("platform"),
        F.coalesce("spend_usd", F.lit(0.0)).alias("spend_usd"),
        "impressions", "clicks", "ads_attributed_orders", "ads_attributed_gmv_usd",
        "direct_gmv_usd", "broad_gmv_usd", "platform_total_orders", "platform_total_gmv_usd",
        X.is_weekend("date_local").alias("is_weekend"),
        X.is_payday("date_local").alias("is_payday"),
        F.col("_mega").isNotNull().alias("is_mega_sale"),
        X.week_monday("date_local").alias("week_of_year"),
        "event_kinds",
    )


def evc_pivot(fact_evc: DataFrame) -> DataFrame:
    """Conditional-sum pivot of the click / evc buckets."""
    b = F.col("attribution_bucket")
    return fact_evc.groupBy("date_local", "market", "channel").agg(
        F.sum(F.when(b == "click", F.col("conversions")).otherwise(0.0)).alias("reported_conversions"),
        F.sum(F.when(b == "evc", F.col("conversions")).otherwise(0.0)).alias("evc_conversions"),
        F.sum(F.when(b == "click", F.col("conversion_value_usd")).otherwise(0.0)).alias("reported_value_usd"),
        F.sum(F.when(b == "evc", F.col("conversion_value_usd")).otherwise(0.0)).alias("evc_value_usd"),
    )


def daily_channel_panel_evc(panel: DataFrame, fact_evc: DataFrame) -> DataFrame:
    """P5 + J7 + PF17: panel with click / engaged-view conversion columns.

    D11: the attributed GMV is exposed under both names.
    """
    e = evc_pivot(fact_evc)
    p = panel.join(e, ["date_local", "market", "channel"], "left")
    reported = F.coalesce(F.col("reported_conversions"), F.col("ads_attributed_orders").cast("double"))
    return p.select(
        "date_local", "market", "channel", "platform", "spend_usd", "impressions", "clicks",
        "ads_attributed_orders", "ads_attributed_gmv_usd",
        F.col("ads_attributed_gmv_usd").alias("reported_gmv_usd"),
        "direct_gmv_usd", "broad_gmv_usd",
        F.coalesce("evc_value_usd", F.lit(0.0)).alias("evc_gmv_usd"),
        (F.col("ads_attributed_gmv_usd") + F.coalesce("evc_value_usd", F.lit(0.0))).alias("all_gmv_usd"),
        reported.alias("reported_conversions"),
        F.coalesce("evc_conversions", F.lit(0.0)).alias("evc_conversions"),
        (reported + F.coalesce("evc_conversions", F.lit(0.0))).alias("all_conversions"),
        "platform_total_orders", "platform_total_gmv_usd", "is_weekend", "is_payday",
        "is_mega_sale", "week_of_year",
    )
