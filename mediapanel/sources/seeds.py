"""Seed and dimension tables (SD1-SD5) plus the media priors.

All tables here are small, bounded by the number of markets, channels or
calendar days, and are built as literal DataFrames so that joins against them
can be broadcast safely.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

D = dt.date

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for right results.
# ---------------------------------------------------------------------------

# Markets: (market, country_name, timezone, currency)
MARKETS = [
    ("ID", "Indonesia", "Asia/Jakarta", "IDR"),
    ("TH", "Thailand", "Asia/Bangkok", "THB"),
    ("VN", "Vietnam", "Asia/Ho_Chi_Minh", "VND"),
    ("MY", "Malaysia", "Asia/Kuala_Lumpur", "MYR"),
    ("SG", "Singapore", "Asia/Singapore", "SGD"),
    ("PH", "Philippines", "Asia/Manila", "PHP"),
]

# Flat indicative FX rates, local currency units per 1 USD.
FX_RATES = [
    ("IDR", "16800.0"),
    ("THB", "36.0"),
    ("VND", "25400.0"),
    ("MYR", "4.60"),
    ("SGD", "1.33"),
    ("PHP", "56.0"),
]

# Channel taxonomy: (channel, label, platform, group, priority)
CHANNELS = [
    ("shopee_organic", "Shopee Organic", "shopee", "organic", 9),
    ("shopee_ads_product_search", "Shopee Product Search", "shopee", "on_platform", 2),
    ("shopee_ads_shop_search", "Shopee Shop Search", "shopee", "on_platform", 4),
    ("shopee_ads_targeting", "Shopee Targeting", "shopee", "on_platform", 3),
    ("shopee_ads_gmv_max", "Shopee GMV Max", "shopee", "on_platform", 1),
    ("shopee_ads_affiliate", "Shopee Affiliate", "shopee", "on_platform", 5),
    ("tiktok_shop_organic", "TikTok Shop Organic", "tiktok_shop", "organic", 10),
    ("tiktok_shop_live", "TikTok Shop Live", "tiktok_shop", "organic", 11),
    ("tiktok_shop_video", "TikTok Shop Video", "tiktok_shop", "organic", 12),
    ("tiktok_ads", "TikTok Ads", "tiktok_shop", "on_platform", 8),
    ("meta_cpas", "Meta CPAS", "shopee", "off_platform", 7),
    ("google_ads_shopee", "Google Ads → Shopee", "shopee", "off_platform", 6),
]

# Traffic-source normalisation: (platform, raw_value, canonical)
TRAFFIC_SOURCES = [
    ("shopee", "organic", "organic"),
    ("shopee", "search", "search"),
    ("shopee", "feed", "organic"),
    ("shopee", "recommendation", "organic"),
    ("shopee", "ads", "ads"),
    ("shopee", "affiliate", "affiliate"),
    ("tiktok_shop", "LIVE", "live"),
    ("tiktok_shop", "VIDEO", "video"),
    ("tiktok_shop", "PRODUCT_CARD", "product_card"),
    ("tiktok_shop", "SEARCH", "search"),
    ("tiktok_shop", "MALL", "organic"),
    ("tiktok_shop", "AFFILIATE", "affiliate"),
]

# Order-status sets (lower-cased).
CANCELLED_STATUSES = ["cancelled", "canceled", "returned", "failed", "refunded"]
COMPLETED_STATUSES = ["completed", "delivered", "shipped"]

# Calendar events: (event_name, event_kind, start, end, markets; None = all)
CALENDAR_EVENTS = [
    ("11.11", "mega_sale", D(2025, 11, 11), D(2025, 11, 11), None),
    ("12.12", "mega_sale", D(2025, 12, 12), D(2025, 12, 12), None),
    ("1.1", "mega_sale", D(2026, 1, 1), D(2026, 1, 1), None),
    ("2.2", "mega_sale", D(2026, 2, 2), D(2026, 2, 2), None),
    ("3.3", "mega_sale", D(2026, 3, 3), D(2026, 3, 3), None),
    ("4.4", "mega_sale", D(2026, 4, 4), D(2026, 4, 4), None),
    ("5.5", "mega_sale", D(2026, 5, 5), D(2026, 5, 5), None),
    ("6.6", "mega_sale", D(2026, 6, 6), D(2026, 6, 6), None),
    ("7.7", "mega_sale", D(2026, 7, 7), D(2026, 7, 7), None),
    ("8.8", "mega_sale", D(2026, 8, 8), D(2026, 8, 8), None),
    ("9.9", "mega_sale", D(2026, 9, 9), D(2026, 9, 9), None),
    ("10.10", "mega_sale", D(2026, 10, 10), D(2026, 10, 10), None),
    ("11.11", "mega_sale", D(2026, 11, 11), D(2026, 11, 11), None),
    ("12.12", "mega_sale", D(2026, 12, 12), D(2026, 12, 12), None),
    ("Harbolnas", "mega_sale", D(2025, 12, 10), D(2025, 12, 15), ["ID"]),
    ("Harbolnas", "mega_sale", D(2026, 12, 10), D(2026, 12, 15), ["ID"]),
    ("Christmas", "festival", D(2025, 12, 20), D(2025, 12, 26), ["SG", "MY", "PH"]),
    ("Christmas", "festival", D(2026, 12, 20), D(2026, 12, 26), ["SG", "MY", "PH"]),
    ("CNY", "festival", D(2026, 2, 10), D(2026, 2, 19), ["SG", "MY", "VN", "PH", "TH"]),
    ("Tet", "festival", D(2026, 2, 15), D(2026, 2, 22), ["VN"]),
    ("Ramadan", "ramadan", D(2026, 2, 18), D(2026, 3, 19), ["ID", "MY"]),
    ("Lebaran", "festival", D(2026, 3, 20), D(2026, 3, 22), ["ID", "MY"]),
    ("Songkran", "festival", D(2026, 4, 13), D(2026, 4, 15), ["TH"]),
]

# Day-of-week demand multipliers (Mon..Sun), payday days and uplift.
DOW_MULTIPLIER = [("Mon", 0.95), ("Tue", 0.90), ("Wed", 0.90), ("Thu", 0.95),
                  ("Fri", 1.05), ("Sat", 1.15), ("Sun", 1.10)]
PAYDAY_DAYS = [1, 15, 16]
PAYDAY_UPLIFT = 1.25

# Channel priors: (channel, adstock_halflife_days, hill_shape, baseline_roas,
#   roas_lo, roas_hi, cpm, ctr, cvr, voucher_subsidy_pct, evc_coverage_pct,
#   daily_spend_baseline)
CHANNEL_PRIORS = [
    ("shopee_ads_product_search", 3.0, 1.8, 5.5, 3.0, 8.0, 2.0, 0.025, 0.080, 0.15, None, 225.0),
    ("shopee_ads_shop_search", 2.5, 1.6, 4.0, 2.0, 6.0, 1.8, 0.022, 0.060, 0.12, None, 90.0),
    ("shopee_ads_targeting", 4.0, 1.9, 3.5, 2.0, 6.0, 2.4, 0.015, 0.045, 0.18, None, 150.0),
    ("shopee_ads_gmv_max", 4.5, 2.1, 4.8, 2.5, 7.0, 2.8, 0.018, 0.055, 0.20, None, 275.0),
    ("shopee_ads_affiliate", 3.0, 1.5, 5.0, 2.5, 7.0, 1.2, 0.030, 0.070, 0.25, None, 60.0),
    ("tiktok_ads", 5.0, 2.0, 2.2, 1.5, 4.0, 3.5, 0.012, 0.040, 0.0, 0.25, 200.0),
    ("meta_cpas", 7.0, 2.0, 6.0, 4.0, 12.0, 4.0, 0.015, 0.060, 0.0, 0.20, 500.0),
    ("google_ads_shopee", 4.0, 1.7, 6.5, 2.5, 7.0, 3.0, 0.035, 0.050, 0.0, 0.18, 1200.0),
]

# Google campaign-type allocation weights and click / engaged-view split
# weights per campaign type.
GOOGLE_CAMPAIGN_TYPE_WEIGHTS = [("SEARCH", 0.35), ("PMAX", 0.25), ("SHOPPING", 0.15),
                                ("DEMAND_GEN", 0.15), ("VIDEO", 0.10)]
GOOGLE_EVC_SPLITS = [("SEARCH", 0.40, 0.02), ("PMAX", 0.30, 0.20),
                     ("DEMAND_GEN", 0.15, 0.45), ("VIDEO", 0.15, 0.33)]
# Shopee ad-type weights.
SHOPEE_AD_TYPE_WEIGHTS = [("product_search", 0.38), ("shop_search", 0.14), ("targeting", 0.20),
                          ("gmv_max", 0.22), ("affiliate", 0.06)]
# Traffic-source weights of the orders per platform.
TRAFFIC_SOURCE_WEIGHTS = [
    ("tiktok_shop", "LIVE", 0.35), ("tiktok_shop", "VIDEO", 0.30), ("tiktok_shop", "PRODUCT_CARD", 0.15),
    ("tiktok_shop", "SEARCH", 0.10), ("tiktok_shop", "MALL", 0.08), ("tiktok_shop", "AFFILIATE", 0.02),
    ("shopee", "organic", 0.45), ("shopee", "search", 0.20), ("shopee", "feed", 0.10),
    ("shopee", "recommendation", 0.10), ("shopee", "ads", 0.13), ("shopee", "affiliate", 0.02),
]
# Meta attribution windows still allowed.
META_ALLOWED_WINDOWS = ["1d_click", "7d_click", "1d_view", "1d_ev"]

# Anomaly levels (first match wins): |ROAS shift| above 25% with spend above
# the floor -> data_issue; spend below -20% -> slump; ROAS shift below -15% ->
# slump; spend above +25% -> spike; else healthy.
ANOMALY_ROAS_SWING = 0.25
ANOMALY_SPEND_SLUMP = -0.20
ANOMALY_ROAS_SLUMP = -0.15
ANOMALY_SPEND_SPIKE = 0.25

# Reallocation rules: (trigger ROAS shift, cut share, scale share).
REALLOC_GOOGLE = (-0.08, 0.15, 0.15)
REALLOC_SHOPEE_ADS = (-0.05, 0.20, 0.12)
REALLOC_SHIFT_SHARE = 0.10
REALLOC_TRIM_IMPACT = 0.4

# Pacing status band: forecast / plan below 0.95 behind, above 1.05 over.
PACING_BAND = (0.95, 1.05)
# Demo per-channel plan factor: 0.85 + (len(channel id) % 5) x 0.07.
CHANNEL_PLAN_BASE, CHANNEL_PLAN_STEP, CHANNEL_PLAN_MOD = 0.85, 0.07, 5

# Invariant tolerances: attributed GMV <= 1.05 x platform total; 1e-6 slack.
DQ_GMV_BOUND = 1.05
DQ_EPS = 1e-6

# GMV cap share of the platform total; voucher share formula: base x (0.7 +
# 0.3 x m / mean(m)) x 1.3 when m > 1.8, clipped to [0, 0.45].
GMV_CAP_SHARE = 0.95
VOUCHER_BASE, VOUCHER_SLOPE, VOUCHER_PEAK_MULT, VOUCHER_PEAK_BOOST, VOUCHER_MAX = 0.7, 0.3, 1.8, 1.3, 0.45
# ROAS band tolerance around the prior band.
ROAS_BAND_TOLERANCE = 0.3

# Ad-type keywords of the objective, in match order.
AD_TYPE_KEYWORDS = ["video", "live", "catalog", "search"]
# Shop-landing rules for Google rows: final URL or campaign-name prefix.
SHOPEE_URL_PATTERN = r"^https?://([a-z]+\.)?shopee\."
SHOPEE_CAMPAIGN_PATTERN = r"^SHP[_-]"
# Conversion kind -> attribution bucket per platform (anything else: click);
# the second map is the reference's, where Meta 1d_view counts as click.
EVC_BUCKETS = {
    "google_ads_shopee": {"engaged_view": "evc", "view_through": "evc", "click_through": "click"},
    "meta_cpas": {"1d_ev": "evc", "1d_view": "evc"},
    "tiktok_ads": {"EVTA": "evc", "VTA": "evc"},
}
EVC_BUCKETS_COMPAT = {**EVC_BUCKETS, "meta_cpas": {"1d_ev": "evc"}}

# What-if scenarios: scenario -> [(channel, metric, op, value)]
SCENARIOS = {
    "competitor_launch": [
        ("shopee_ads_product_search", "ads_gmv_usd", "mul", 0.8),
        ("shopee_ads_gmv_max", "ads_gmv_usd", "mul", 0.8),
        ("tiktok_ads", "ads_gmv_usd", "mul", 0.8),
        ("meta_cpas", "ads_gmv_usd", "mul", 0.85),
        ("google_ads_shopee", "ads_gmv_usd", "mul", 0.85),
    ],
    "supply_shortage": [
        ("shopee_organic", "platform_total_gmv_usd", "mul", 0.5),
        ("tiktok_shop_organic", "platform_total_gmv_usd", "mul", 0.5),
    ],
    "algo_change": [("tiktok_ads", "clicks", "mul", 0.7)],
    "viral_moment": [("tiktok_shop_organic", "platform_total_gmv_usd", "mul", 3.0)],
    "category_headwind": [
        ("shopee_organic", "platform_total_gmv_usd", "mul", 0.82),
        ("tiktok_shop_organic", "platform_total_gmv_usd", "mul", 0.82),
    ],
    "price_war": [
        ("shopee_ads_product_search", "ads_orders", "mul", 1.15),
        ("shopee_ads_gmv_max", "ads_orders", "mul", 1.15),
        ("tiktok_ads", "ads_orders", "mul", 1.15),
    ],
}

# ---------------------------------------------------------------------------
# DataFrame builders
# ---------------------------------------------------------------------------

MARKET_CODES = [m[0] for m in MARKETS]
PAID_CHANNELS = [c[0] for c in CHANNELS if c[3] != "organic"]


def dim_market(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MARKETS, "market string, country_name string, timezone string, currency string")


def channel_taxonomy(spark: SparkSession) -> DataFrame:
    rows = [(c, lbl, p, g, pr, i) for i, (c, lbl, p, g, pr) in enumerate(CHANNELS)]
    return spark.createDataFrame(
        rows, "channel string, label string, platform string, group string, priority int, tax_order int")


def traffic_source_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRAFFIC_SOURCES, "platform string, raw_value string, canonical string")


def channel_priors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CHANNEL_PRIORS,
        "channel string, halflife double, hill_shape double, baseline_roas double, roas_lo double, "
        "roas_hi double, cpm double, ctr double, cvr double, voucher_pct double, "
        "evc_coverage double, daily_spend double")


def event_windows(spark: SparkSession, events=None) -> DataFrame:
    """(event_name, event_kind, start, end, markets) windows; markets NULL = all."""
    events = CALENDAR_EVENTS if events is None else events
    rows = [(n, k, s, e, m) for (n, k, s, e, m, *_) in events]
    return spark.createDataFrame(
        rows, "event_name string, event_kind string, start date, end date, markets array<string>")


def calendar_events(spark: SparkSession, events=None) -> DataFrame:
    """SD5: expand event windows to one row per (date, market, event_name).

    The expansion is bounded by calendar days x markets, so the result is a
    small dimension that downstream joins may broadcast.
    """
    w = event_windows(spark, events)
    all_markets = F.array(*[F.lit(m) for m in MARKET_CODES])
    return (w.withColumn("date", F.explode(F.sequence("start", "end")))
             .withColumn("market", F.explode(F.coalesce("markets", all_markets)))
             .select("date", "market", "event_name", "event_kind"))


def fx_rates(spark: SparkSession, start: dt.date, end: dt.date, rates=None,
             missing: list[tuple[dt.date, str]] | None = None) -> DataFrame:
    """SD2: flat-rate daily FX spine (date x currency); ``missing`` pairs are
    left out to model gaps in a provider feed."""
    rates = FX_RATES if rates is None else rates
    cur = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(Decimal(r)).cast("decimal(12,6)").alias("usd_rate"))
                    for c, r in rates])
    # Date spine x currencies as an explode of a literal array: no join.
    fx = (spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
          .select("date", F.inline(cur)))
    if missing:
        gaps = spark.createDataFrame(missing, "date date, currency string")
        fx = fx.join(F.broadcast(gaps), ["date", "currency"], "left_anti")
    return fx.select("date", "currency", "usd_rate")
