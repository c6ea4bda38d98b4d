"""Gold facts: daily aggregates of the silver streams (A1-A6, PF9, J3, J11).

Every fact is a single hash aggregation (partial map-side, final after one
shuffle on the grain), followed by a broadcast FX lookup.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

# Grain = upsert key (null-safe, D7) of each fact. Other attributes are those
# of the key's latest row.
SALES_KEY = ["date_local", "market", "platform", "shop_id", "sku_id"]
ONPLATFORM_KEY = ["date_local", "market", "platform", "ad_type", "campaign_id", "ad_group_id", "sku_id"]
ONPLATFORM_ATTRS = ["objective", "attribution_window", "currency"]
OFFPLATFORM_KEY = ["date_local", "market", "platform", "campaign_id", "ad_set_or_ad_group_id"]
OFFPLATFORM_ATTRS = ["destination_platform", "campaign_type", "catalog_id", "attribution_window", "currency"]
EVC_KEY = ["date_local", "market", "channel", "attribution_bucket"]
KEYS = {"fact_platform_sales": SALES_KEY, "fact_onplatform_ads": ONPLATFORM_KEY,
        "fact_offplatform_ads": OFFPLATFORM_KEY, "fact_evc": EVC_KEY,
        "panel": ["date_local", "market", "channel"], "panel_evc": ["date_local", "market", "channel"]}


def refresh_window(df: DataFrame, as_of: dt.date, days: int | None) -> Column:
    """PF9: rows inside the rolling refresh window; ``days=None`` = all
    history. Rows without a local date never qualify."""
    d = F.col("date_local")
    if days is None:
        return d.isNotNull()
    return d >= F.date_sub(F.lit(as_of), days)


def _fx(df: DataFrame, fx: DataFrame) -> DataFrame:
    f = fx.select(F.col("date").alias("_fx_date"), F.col("currency").alias("_fx_cur"), "usd_rate")
    return df.join(F.broadcast(f), (F.col("date_local") == F.col("_fx_date"))
                   & (F.col("currency") == F.col("_fx_cur")), "left").drop("_fx_date", "_fx_cur")


def _dealt(df: DataFrame, key: list[str], day_ranges: bool) -> DataFrame:
    """Rows of a key in one task: dealt by hash or, for a writer of day folders,
    by ranges of the key, which begins with the day. Ranges are drawn from a
    sample of the keys, so a hot day is split across tasks and a task has few
    days: the fact can be written as it is, without another shuffle by day."""
    return df.repartitionByRange(*key) if day_ranges else df.repartition(*key)


def fact_platform_sales(stg: DataFrame, fx: DataFrame, as_of: dt.date,
                        refresh_days: int | None = None, day_ranges: bool = False) -> DataFrame:
    """A1 + A2 + PF8: order-line counts, gross and net GMV, and the traffic mix;
    one row per key (D7), whatever currencies its orders were paid in.

    The traffic mix is built in the same pass (J4 avoided), after one shuffle by
    key: level one groups by key, currency and traffic source with all measures
    (hash aggregate of constant memory per group), level two gets the USD amounts
    of each currency and level three folds the currencies of a key, all in place.
    Counts and USD amounts are plain sums, so readers of these alone collect
    nothing. The currency is that of the key's latest row; local amounts paid in
    another one are converted to it by way of USD, and are NULL where a rate is
    missing.
    """
    base = stg.where(refresh_window(stg, as_of, refresh_days))
    lvl1 = _dealt(base, SALES_KEY, day_ranges).groupBy(*SALES_KEY, "currency", "traffic_source").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_if(F.col("is_cancelled")).alias("n_cancelled"),
        F.sum("gmv_local").alias("gross"),
        F.sum(F.when(F.col("is_cancelled"), F.lit(0)).otherwise(F.col("gmv_local"))).alias("net"),
        F.max("ingested_at").alias("at"),
    )
    lvl2 = lvl1.groupBy(*SALES_KEY, "currency").agg(
        F.sum("cnt").alias("cnt"), F.sum("n_cancelled").alias("n_cancelled"), F.sum("gross").alias("gross"),
        F.sum("net").alias("net"), F.max("at").alias("at"),
        F.collect_list(F.struct("traffic_source", "cnt")).alias("mix"))
    lvl2 = _fx(lvl2, fx).withColumn("usd", X.usd("net", "usd_rate"))
    paid = F.sort_array(F.collect_list(F.struct("at", "currency", "usd_rate", "gross", "net")), asc=False)
    agg = lvl2.groupBy(*SALES_KEY).agg(
        F.sum("cnt").alias("orders_gross"), F.sum("n_cancelled").alias("orders_cancelled"),
        F.sum("usd").alias("usd"), F.count_if(F.col("usd").isNull()).alias("n_unpriced"),
        paid.alias("paid"), F.flatten(F.collect_list("mix")).alias("mix"))
    latest = F.get("paid", F.lit(0))

    def local(name):
        """Amounts in the latest currency, others converted to it."""
        own = lambda x: x["currency"].eqNullSafe(latest["currency"])
        other = lambda x: F.round((x[name].cast("double") / x["usd_rate"].cast("double")
                                   * latest["usd_rate"].cast("double")).cast("decimal(38,10)"), 4).cast("decimal(28,4)")
        several = F.aggregate("paid", F.lit(0).cast("decimal(28,4)"), lambda t, x: (
            t + F.when(own(x), x[name].cast("decimal(28,4)")).otherwise(other(x))).cast("decimal(28,4)"))
        return F.when(F.size("paid") == 1, latest[name].cast("decimal(28,4)")).otherwise(several)

    usd = F.when(F.col("n_unpriced") == 0, F.col("usd"))
    sources = F.sort_array(F.array_distinct(F.col("mix")["traffic_source"]))
    mix = F.when(F.size("mix") == 1, F.col("mix")).otherwise(F.transform(sources, lambda s: F.struct(
        s.alias("traffic_source"), F.aggregate(
            F.filter("mix", lambda m: m["traffic_source"].eqNullSafe(s)), F.lit(0).cast("long"),
            lambda t, m: t + m["cnt"]).alias("cnt"))))
    out = agg.withColumn("orders_net", F.col("orders_gross") - F.col("orders_cancelled"))
    return out.select(*SALES_KEY, "orders_gross", "orders_cancelled", "orders_net",
                      local("gross").alias("gmv_gross_local"), local("net").alias("gmv_net_local"),
                      usd.alias("gmv_net_usd"), latest["currency"].alias("currency"), mix.alias("traffic_source_mix"))


def _latest_attributes(base: DataFrame, key: list[str], attrs: list[str], sums: list[str],
                       day_ranges: bool = False) -> DataFrame:
    """Sums per key, with the attributes of the key's latest row (ties by the
    attributes, descending, nulls last).

    Two levels, as in the sales fact: rows are summed per key and attributes
    (hash aggregate, combined before the shuffle), then the few attribute
    combinations of a key are folded, the latest one winning."""
    lvl1 = base.groupBy(*key, *attrs).agg(F.max("ingested_at").alias("_at"), *[F.sum(c).alias(c) for c in sums])
    types = {f.name: f.dataType.simpleString() for f in lvl1.schema.fields}
    if day_ranges:
        lvl1 = _dealt(lvl1, key, True)
    latest = F.array_max(F.collect_list(F.struct("_at", *attrs)))
    lvl2 = lvl1.groupBy(*key).agg(latest.alias("_latest"), *[F.sum(c).cast(types[c]).alias(c) for c in sums])
    return lvl2.select(*key, *[F.col(f"_latest.{a}").alias(a) for a in attrs], *sums)


def fact_onplatform_ads(stg: DataFrame, as_of: dt.date, refresh_days: int | None = None,
                        day_ranges: bool = False) -> DataFrame:
    """A3: eleven sums per key."""
    base = stg.where(refresh_window(stg, as_of, refresh_days))
    sums = ["spend_local", "spend_usd", "impressions", "clicks", "video_views_2s_or_6s",
            "direct_orders", "broad_orders", "direct_gmv_local", "broad_gmv_local",
            "direct_gmv_usd", "broad_gmv_usd"]
    return _latest_attributes(base, ONPLATFORM_KEY, ONPLATFORM_ATTRS, sums, day_ranges)


def fact_offplatform_ads(stg: DataFrame, as_of: dt.date, refresh_days: int | None = None,
                         day_ranges: bool = False) -> DataFrame:
    """A4: eight sums per key."""
    base = stg.where(refresh_window(stg, as_of, refresh_days))
    sums = ["spend_local", "spend_usd", "impressions", "clicks", "add_to_cart", "purchases_reported",
            "purchase_value_reported_local", "purchase_value_reported_usd"]
    return _latest_attributes(base, OFFPLATFORM_KEY, OFFPLATFORM_ATTRS, sums, day_ranges)


def fact_evc(stg: DataFrame, dim_market: DataFrame, fx: DataFrame, as_of: dt.date,
             refresh_days: int | None = None) -> DataFrame:
    """EVC in USD; currency from the market, rate from (date, currency)."""
    s = stg.join(F.broadcast(dim_market.select("market", "currency")), "market", "left")
    s = _fx(s.where(refresh_window(s, as_of, refresh_days)), fx)
    return s.groupBy(*EVC_KEY, "currency").agg(
        F.sum("conversions").alias("conversions"),
        F.sum("conversion_value_local").alias("conversion_value_local"),
        F.try_divide(F.sum("conversion_value_local").cast("double"),
                     F.max("usd_rate").cast("double")).alias("conversion_value_usd"),
    )
