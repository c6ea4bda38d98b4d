"""IO1: declared schemas of the nine raw feeds (bronze), plus the lineage block.

Loads read with these schemas; unknown fields are dropped and nothing is
inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(12, 6)

S, L, DB, DT, TS = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType()

LINEAGE = [
    ("_source_system", S), ("_market", S), ("_accounts", S),
    ("_window_start", DT), ("_window_end", DT), ("ingested_at", TS),
]


def _schema(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in list(cols) + LINEAGE])


TIKTOK_SHOP_ORDERS = _schema([
    ("Date", DT), ("Order_id", S), ("Order_status", S), ("Order_create_time", TS),
    ("Payment_time", TS), ("Buyer_country", S), ("Shop_id", S), ("Sku_id", S), ("Product_id", S),
    ("Quantity", L), ("Original_price", MONEY), ("Sub_total", MONEY), ("Order_amount", MONEY),
    ("Currency", S), ("Shipping_fee", MONEY), ("Order_source", S), ("Affiliate_creator_id", S),
])

TIKTOK_ADS_DAILY = _schema([
    ("Date", DT), ("Advertiser_id", S), ("Campaign_id", S), ("Campaign_name", S),
    ("Objective_type", S), ("Ad_group_id", S), ("Ad_group_name", S), ("Ad_id", S), ("Ad_name", S),
    ("Country_code", S), ("Currency", S), ("Spend", MONEY), ("Impressions", L), ("Clicks", L),
    ("Ctr", DB), ("Cpc", MONEY), ("Video_play_6s", L), ("Complete_payment", L),
    ("Complete_payment_value", MONEY), ("Skan_complete_payment", L),
    ("Conversion_attribution_window", S),
])

SHOPEE_ORDERS = _schema([
    ("Date", DT), ("Order_sn", S), ("Order_status", S), ("Create_time", TS), ("Pay_time", TS),
    ("Complete_time", TS), ("Buyer_id_hash", S), ("Shop_id", S), ("Country", S), ("Sku", S),
    ("Item_id", S), ("Quantity", L), ("Merchandise_subtotal", MONEY), ("Escrow_amount", MONEY),
    ("Currency", S), ("Logistics_status", S), ("Voucher_platform", MONEY),
    ("Voucher_seller", MONEY), ("Traffic_source", S),
])

SHOPEE_ADS_DAILY = _schema([
    ("Date", DT), ("Shop_id", S), ("Country", S), ("Currency", S), ("Ad_type", S),
    ("Campaign_id", S), ("Campaign_name", S), ("Sku_id", S), ("Keyword", S), ("Match_type", S),
    ("Spend", MONEY), ("Voucher_subsidy", MONEY), ("Impressions", L), ("Clicks", L),
    ("Direct_orders", L), ("Broad_orders", L), ("Direct_gmv", MONEY), ("Broad_gmv", MONEY),
    ("Attribution_window", S),
])

META_CPAS_DAILY = _schema([
    ("Date", DT), ("Account_id", S), ("Campaign_id", S), ("Campaign_name", S), ("Adset_id", S),
    ("Adset_name", S), ("Ad_id", S), ("Objective", S), ("Catalog_id", S), ("Partner_id", S),
    ("Country", S), ("Currency", S), ("Spend", MONEY), ("Impressions", L), ("Reach", L),
    ("Link_clicks", L), ("Add_to_cart", L), ("Purchase", L), ("Purchase_value", MONEY),
    ("Roas", DB), ("Attribution_window", S),
])

GOOGLE_ADS_SHOPEE_DAILY = _schema([
    ("Date", DT), ("Customer_id", S), ("Campaign_id", S), ("Campaign_name", S),
    ("Campaign_type", S), ("Ad_group_id", S), ("Ad_group_name", S), ("Keyword", S),
    ("Final_url", S), ("Country", S), ("Currency", S), ("Cost_micros", L), ("Spend", MONEY),
    ("Impressions", L), ("Clicks", L), ("Conversions", DB), ("Conversion_value", MONEY),
    ("All_conversions", DB), ("Attribution_model", S),
])

EVC_GOOGLE = _schema([
    ("date", DT), ("customer_id", S), ("campaign_id", S), ("campaign_name", S),
    ("campaign_type", S), ("ad_event_type", S), ("conversions", DB),
    ("conversions_value", MONEY), ("all_conversions", DB), ("all_conversions_value", MONEY),
])

EVC_META = _schema([
    ("date", DT), ("account_id", S), ("campaign_id", S), ("campaign_name", S), ("adset_id", S),
    ("attribution_window", S), ("action_type", S), ("action_count", L), ("action_value", MONEY),
])

EVC_TIKTOK = _schema([
    ("date", DT), ("advertiser_id", S), ("campaign_id", S), ("adgroup_id", S),
    ("attribution_type", S), ("attribution_window_days", L), ("conversions", L),
    ("conversion_value", MONEY),
])

RAW_SCHEMAS = {
    "tiktok_shop_orders": TIKTOK_SHOP_ORDERS,
    "tiktok_ads_daily": TIKTOK_ADS_DAILY,
    "shopee_orders": SHOPEE_ORDERS,
    "shopee_ads_daily": SHOPEE_ADS_DAILY,
    "meta_cpas_daily": META_CPAS_DAILY,
    "google_ads_shopee_daily": GOOGLE_ADS_SHOPEE_DAILY,
    "evc_google": EVC_GOOGLE,
    "evc_meta": EVC_META,
    "evc_tiktok": EVC_TIKTOK,
}

# Natural keys per raw feed (D1: sku added for shop ads, market for all).
NATURAL_KEYS = {
    "tiktok_shop_orders": ["Order_id", "Sku_id"],
    "shopee_orders": ["Order_sn", "Sku"],
    "tiktok_ads_daily": ["Date", "Advertiser_id", "Campaign_id", "Ad_group_id", "Ad_id"],
    "shopee_ads_daily": ["Date", "Shop_id", "Campaign_id", "Ad_type", "Keyword", "Sku_id"],
    "meta_cpas_daily": ["Date", "Account_id", "Campaign_id", "Adset_id", "Ad_id"],
    "google_ads_shopee_daily": ["Date", "Customer_id", "Campaign_id", "Ad_group_id", "Keyword"],
}
