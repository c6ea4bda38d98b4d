"""Bind the driver's tables to the raw marketplace and ad-platform feeds.

The test data has no marketing tables, so the nine raw feeds are derived
deterministically from ``lineitem``/``orders``/``customer`` (order lines) and
``events`` (ad rows and conversion-API rows). The same derivation is written
in DuckDB SQL in ``mediapanel.plans.oracle`` so both engines see identical
bronze data. Everything is a projection or a key join of the driver tables,
so the feeds grow with them.

Rules (deterministic, integer arithmetic where money is involved):

* market = MARKETS[k % 6], k = customer nation for orders, event_id for events
* order lines: platform shopee when o_orderkey is even, else tiktok_shop;
  sku = line number, so (order, sku) repeats: a genuine re-ingest dedup case
* create time = 2024-01-01 + (orderdate - 1995-01-01) % 30 days
  + (o_orderkey * 7919) % 86400 s; ingested = create + (|ship - order| % 120)
  hours, so a row is never ingested before it is created
* money: cents = round(l_extendedprice * 100); subtotal = cents * (100 -
  discount%) / 10000; TikTok adds a shipping fee of tax% units
* ads: slot = (event_id div 6) % 8 picks the connector / ad type; view = 100
  impressions, click = 10 impressions + 10 clicks, purchase = 1 impression,
  click and order with GMV 3 x value, signup = add-to-cart; error rows are
  dropped; spend = value x 10 on view and click rows
* every event with event_id % 7 = 0 is restated one day later with doubled
  measures, so the latest-wins dedup has real work to do; every event with
  event_id % 13 = 0 comes twice at the same moment, the versions differing in
  nothing but the attribution window, so ties have to be broken
* event_id % 2 splits the last objective in two that share an ad type, so one
  campaign key has rows of both
* conversion-API rows: purchases of slots 5-7; event_id % 5 = 0 is a
  view / engaged-view conversion, the rest click-through
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_SCHEMAS
from .seeds import MARKET_CODES

AS_OF = dt.date(2024, 1, 30)
WINDOW_START = AS_OF - dt.timedelta(days=13)
EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z

# Calendar events of the test month: (name, kind, start, end, markets, uplift)
TEST_EVENTS = [
    ("1.1", "mega_sale", dt.date(2024, 1, 1), dt.date(2024, 1, 1), None, 1.8),
    ("Test Festival", "festival", dt.date(2024, 1, 10), dt.date(2024, 1, 14), ["ID", "MY"], 1.3),
    ("Songkran test", "festival", dt.date(2024, 1, 20), dt.date(2024, 1, 22), ["TH"], 1.2),
]
# Events bound to channels (D20): (name, kind, start, end, markets, uplift, channels)
TEST_CHANNEL_EVENTS = [
    ("Live week", "custom", dt.date(2024, 1, 15), dt.date(2024, 1, 18), None, 1.5, ["tiktok_ads"]),
    ("Search push", "custom", dt.date(2024, 1, 20), dt.date(2024, 1, 21), ["TH", "SG"], 1.1,
     ["shopee_ads_product_search", "shopee_ads_shop_search"]),
]
# FX spine of the test data, with one provider gap.
FX_START, FX_END = dt.date(2023, 12, 1), dt.date(2024, 2, 29)
FX_MISSING = [(dt.date(2024, 1, 17), "VND")]

_MK = "array(" + ", ".join(f"'{m}'" for m in MARKET_CODES) + ")"
_CUR = "array('IDR', 'THB', 'VND', 'MYR', 'SGD', 'PHP')"


TABLES = ("lineitem", "orders", "customer", "events")
INGEST_DAY = "ingest_date"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; ``spark.sql.files.maxPartitionBytes`` sets its splits."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _landing(rows: DataFrame) -> list[str]:
    """The day of a feed that is being landed."""
    return [c for c in rows.columns if c == INGEST_DAY]


def _lineage(system: str, market_col: str = "market_field") -> list[str]:
    return [
        f"'{system}' AS _source_system",
        f"{market_col} AS _market",
        "concat('acct-', market) AS _accounts",
        f"DATE'{WINDOW_START}' AS _window_start",
        f"DATE'{AS_OF}' AS _window_end",
    ]


_CREATE = (f"{EPOCH_2024} + (datediff(order_day, DATE'1995-01-01') % 30) * 86400"
           " + (o_orderkey * 7919) % 86400")
_LAG = "(abs(datediff(ship_day, order_day)) % 120) * 3600"
_EVENT_INGEST = "CASE WHEN ver = 2 THEN ts_utc + INTERVAL 1 DAYS ELSE ts_utc + INTERVAL 1 HOURS END"


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer: what the order-line fields are derived from.

    Fields that need one table are derived before the join, so narrow integers
    and flags are shuffled. The orders' side is hashed per shuffle partition
    (``size_shuffles`` keeps it small), so the order lines are never sorted."""
    li = read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_quantity AS bigint) AS l_quantity",
        "cast(round(l_extendedprice * 100) AS bigint) AS cents",
        "cast(round(l_discount * 100) AS bigint) AS dpct",
        "cast(round(l_tax * 100) AS bigint) AS tpct",
        "l_returnflag = 'R' AND l_linestatus = 'F' AS returned",
        "cast(l_shipdate AS date) AS ship_day")
    od = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderstatus",
                                                        "cast(o_orderdate AS date) AS order_day")
    cu = read_table(spark, sf_dir, "customer").selectExpr("c_custkey", "cast(c_nationkey % 6 AS int) + 1 AS market_idx")
    oc = od.join(cu, od.o_custkey == cu.c_custkey)
    b = li.join(oc.hint("shuffle_hash"), li.l_orderkey == oc.o_orderkey)
    return b.drop("l_orderkey", "c_custkey")


def order_fields(rows: DataFrame) -> DataFrame:
    """The derived order-line fields of ``order_rows``, row by row."""
    return rows.selectExpr(
        "o_orderkey", "o_custkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "cents", "dpct", "tpct",
        f"element_at({_MK}, market_idx) AS market",
        f"element_at({_CUR}, market_idx) AS mk_currency",
        f"{_CREATE} AS create_secs",
        f"{_LAG} AS ingest_lag",
        "CASE WHEN returned THEN 'returned'"
        " WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped'"
        " WHEN o_orderstatus = 'P' THEN 'cancelled' END AS status",
        "cast(l_suppkey % 6 AS int) + 1 AS src_idx",
        *_landing(rows),
    ).selectExpr(
        "*",
        "CASE WHEN o_orderkey % 101 = 0 THEN 'ZZ' ELSE market END AS country",
        "CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 10 = 7 THEN NULL ELSE market END AS market_field",
        "CASE WHEN o_orderkey % 101 = 0 THEN 'USD' WHEN o_orderkey % 7 = 3 THEN 'SGD' ELSE mk_currency END AS currency",
        "timestamp_seconds(create_secs) AS create_ts",
        "timestamp_seconds(create_secs + ingest_lag) AS ingest_ts",
        "cast(cents * (100 - dpct) / 10000.0 AS decimal(18,4)) AS subtotal",
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer with the derived order-line fields."""
    return order_fields(order_rows(spark, sf_dir))


def shopee_orders(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else order_base(spark, sf_dir)).where("o_orderkey % 2 = 0")
    return b.selectExpr(
        "cast(create_ts AS date) AS Date",
        "concat('SO', cast(o_orderkey AS string)) AS Order_sn",
        "upper(status) AS Order_status",
        "create_ts AS Create_time",
        "create_ts + INTERVAL 10 MINUTES AS Pay_time",
        "CASE WHEN status = 'completed' THEN create_ts + INTERVAL 3 DAYS END AS Complete_time",
        "concat('b', cast(o_custkey AS string)) AS Buyer_id_hash",
        "concat('shop-', cast(l_suppkey AS string)) AS Shop_id",
        "country AS Country",
        "concat('SKU-', cast(l_linenumber AS string)) AS Sku",
        "concat('item-', cast(l_partkey AS string)) AS Item_id",
        "cast(l_quantity AS bigint) AS Quantity",
        "subtotal AS Merchandise_subtotal",
        "subtotal AS Escrow_amount",
        "currency AS Currency",
        "'delivered' AS Logistics_status",
        "cast(0 AS decimal(18,4)) AS Voucher_platform",
        "cast(0 AS decimal(18,4)) AS Voucher_seller",
        "element_at(array('Organic', 'search', 'FEED', 'recommendation', 'ads', 'livestream'), src_idx)"
        " AS Traffic_source",
        *_lineage("shopee_orders_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["shopee_orders"].fields] + _landing(b))


def tiktok_shop_orders(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else order_base(spark, sf_dir)).where("o_orderkey % 2 = 1")
    return b.selectExpr(
        "cast(create_ts AS date) AS Date",
        "concat('TT', cast(o_orderkey AS string)) AS Order_id",
        "CASE status WHEN 'completed' THEN 'Completed' WHEN 'shipped' THEN 'Shipped'"
        " WHEN 'cancelled' THEN 'Canceled' WHEN 'returned' THEN 'Returned' END AS Order_status",
        "create_ts AS Order_create_time",
        "create_ts + INTERVAL 5 MINUTES AS Payment_time",
        "country AS Buyer_country",
        "concat('shop-', cast(l_suppkey AS string)) AS Shop_id",
        "concat('SKU-', cast(l_linenumber AS string)) AS Sku_id",
        "concat('item-', cast(l_partkey AS string)) AS Product_id",
        "cast(l_quantity AS bigint) AS Quantity",
        "cast(cents / 100.0 AS decimal(18,4)) AS Original_price",
        "subtotal AS Sub_total",
        "cast(subtotal + cast(tpct AS decimal(18,4)) AS decimal(18,4)) AS Order_amount",
        "currency AS Currency",
        "cast(tpct AS decimal(18,4)) AS Shipping_fee",
        "element_at(array('LIVE', 'VIDEO', 'PRODUCT_CARD', 'SEARCH', 'MALL', 'Showcase'), src_idx)"
        " AS Order_source",
        "CAST(NULL AS string) AS Affiliate_creator_id",
        *_lineage("tiktok_shop_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["tiktok_shop_orders"].fields] + _landing(b))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events (minus errors) plus restated versions: what the ad fields are
    derived from."""
    ev = read_table(spark, sf_dir, "events").where("event_type <> 'error'").selectExpr(
        "event_id", "user_id", "event_type", "cast(ts AS date) AS d", "cast(ts AS timestamp) AS ts_utc",
        "cast(round(value * 100) AS bigint) AS cents")
    # Original load, ingested one hour after the event; restatements of every
    # seventh event one day later with doubled measures.
    v1 = ev.selectExpr("*", "1 AS ver")
    v2 = ev.where("event_id % 7 = 0").selectExpr("*", "2 AS ver")
    v3 = ev.where("event_id % 13 = 0").selectExpr("*", "3 AS ver")
    return v1.unionByName(v2).unionByName(v3)


def event_fields(rows: DataFrame) -> DataFrame:
    """The derived ad fields of ``event_rows``, row by row."""
    return rows.selectExpr(
        "*",
        f"element_at({_MK}, cast(event_id % 6 AS int) + 1) AS market",
        f"element_at({_CUR}, cast(event_id % 6 AS int) + 1) AS currency",
        "cast((event_id div 6) % 8 AS int) AS slot",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE element_at("
        f"{_MK}, cast(event_id % 6 AS int) + 1) END AS market_field",
        "CASE WHEN ver = 2 THEN 2 ELSE 1 END AS mult",
        f"{_EVENT_INGEST} AS ingest_ts",
    ).selectExpr(
        "*",
        "mult * CASE event_type WHEN 'view' THEN 100 WHEN 'click' THEN 10 ELSE 1 END AS impressions",
        "mult * CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 10 ELSE 1 END AS clicks",
        "mult * CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS orders",
        "mult * CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS atc",
        "cast(CASE WHEN event_type IN ('view', 'click') THEN mult * cents ELSE 0 END / 10.0"
        " AS decimal(18,4)) AS spend",
        "cast(CASE WHEN event_type = 'purchase' THEN mult * cents * 3 ELSE 0 END / 100.0"
        " AS decimal(18,4)) AS gmv",
        "concat('cmp-', cast(user_id % 20 AS string)) AS campaign",
    )


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events (minus errors) with derived ad fields, plus restated versions."""
    return event_fields(event_rows(spark, sf_dir))


def tiktok_ads_daily(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else event_base(spark, sf_dir)).where("slot = 5")
    return b.selectExpr(
        "d AS Date",
        "concat('adv-', market) AS Advertiser_id",
        "campaign AS Campaign_id",
        "concat('Campaign ', campaign) AS Campaign_name",
        "element_at(array('VIDEO_SHOPPING', 'LIVE_SHOPPING', 'PRODUCT_CATALOG_SALES', 'SEARCH_ADS',"
        " CASE WHEN event_id % 2 = 0 THEN 'TRAFFIC' ELSE 'REACH' END), cast(user_id % 5 AS int) + 1)"
        " AS Objective_type",
        "CASE WHEN user_id % 9 = 0 THEN NULL ELSE concat('ag-', cast(user_id % 40 AS string)) END"
        " AS Ad_group_id",
        "CAST(NULL AS string) AS Ad_group_name",
        "concat('ad-', cast(event_id AS string)) AS Ad_id",
        "CAST(NULL AS string) AS Ad_name",
        "market AS Country_code",
        "currency AS Currency",
        "spend AS Spend",
        "cast(impressions AS bigint) AS Impressions",
        "cast(clicks AS bigint) AS Clicks",
        "CAST(NULL AS double) AS Ctr",
        "CAST(NULL AS decimal(18,4)) AS Cpc",
        "cast(CASE WHEN event_type = 'view' THEN 20 * mult ELSE 0 END AS bigint) AS Video_play_6s",
        "cast(orders AS bigint) AS Complete_payment",
        "gmv AS Complete_payment_value",
        "CAST(NULL AS bigint) AS Skan_complete_payment",
        "CASE WHEN ver = 3 THEN '1d_click' ELSE '7d_click' END AS Conversion_attribution_window",
        *_lineage("tiktok_ads_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["tiktok_ads_daily"].fields] + _landing(b))


def shopee_ads_daily(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else event_base(spark, sf_dir)).where("slot < 5")
    return b.selectExpr(
        "d AS Date",
        "concat('shop-', market) AS Shop_id",
        "market AS Country",
        "currency AS Currency",
        "element_at(array('Product_Search', 'shop_search', 'TARGETING', 'gmv_max', 'Affiliate'),"
        " slot + 1) AS Ad_type",
        "campaign AS Campaign_id",
        "concat('Campaign ', campaign) AS Campaign_name",
        "CASE WHEN user_id % 11 = 0 THEN NULL ELSE concat('SKU-', cast(user_id % 7 AS string)) END"
        " AS Sku_id",
        "concat('kw-', cast(event_id AS string)) AS Keyword",
        "'exact' AS Match_type",
        "spend AS Spend",
        "cast(spend * 0.15 AS decimal(18,4)) AS Voucher_subsidy",
        "cast(impressions AS bigint) AS Impressions",
        "cast(clicks AS bigint) AS Clicks",
        "cast(CASE WHEN user_id % 5 < 3 THEN orders ELSE 0 END AS bigint) AS Direct_orders",
        "cast(orders AS bigint) AS Broad_orders",
        "cast(gmv * 0.6 AS decimal(18,4)) AS Direct_gmv",
        "gmv AS Broad_gmv",
        "CASE WHEN ver = 3 THEN '1d' ELSE '7d' END AS Attribution_window",
        *_lineage("shopee_ads_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["shopee_ads_daily"].fields] + _landing(b))


def meta_cpas_daily(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else event_base(spark, sf_dir)).where("slot = 6")
    return b.selectExpr(
        "d AS Date",
        "concat('act-', market) AS Account_id",
        "campaign AS Campaign_id",
        "concat('CPAS ', campaign) AS Campaign_name",
        "concat('as-', cast(user_id % 40 AS string)) AS Adset_id",
        "CAST(NULL AS string) AS Adset_name",
        "concat('ad-', cast(event_id AS string)) AS Ad_id",
        "CASE WHEN user_id % 10 = 9 THEN 'CONVERSIONS' ELSE 'PRODUCT_CATALOG_SALES' END AS Objective",
        "concat('cat-', market) AS Catalog_id",
        "'partner-shopee' AS Partner_id",
        "market AS Country",
        "currency AS Currency",
        "spend AS Spend",
        "cast(impressions AS bigint) AS Impressions",
        "cast(impressions AS bigint) AS Reach",
        "cast(clicks AS bigint) AS Link_clicks",
        "cast(atc AS bigint) AS Add_to_cart",
        "cast(orders AS bigint) AS Purchase",
        "gmv AS Purchase_value",
        "CAST(NULL AS double) AS Roas",
        "CASE WHEN ver = 3 THEN '1d_click' ELSE '7d_click' END AS Attribution_window",
        *_lineage("meta_ads_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["meta_cpas_daily"].fields] + _landing(b))


def google_ads_shopee_daily(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else event_base(spark, sf_dir)).where("slot = 7")
    return b.selectExpr(
        "d AS Date",
        "concat('cus-', market) AS Customer_id",
        "campaign AS Campaign_id",
        "element_at(array('Shopee Always On', 'SHP_Brand', 'SHP-Generic', 'Brand Awareness'),"
        " cast(user_id % 4 AS int) + 1) AS Campaign_name",
        "element_at(array('SEARCH', 'PMAX', 'SHOPPING', 'DEMAND_GEN', 'VIDEO'),"
        " cast(user_id % 5 AS int) + 1) AS Campaign_type",
        "concat('ag-', cast(user_id % 40 AS string)) AS Ad_group_id",
        "CAST(NULL AS string) AS Ad_group_name",
        "concat('kw-', cast(event_id AS string)) AS Keyword",
        "element_at(array('https://shopee.co.id/shop', 'https://www.example.com/',"
        " 'https://mall.shopee.sg/p', 'https://www.example.com/lp'), cast(user_id % 4 AS int) + 1)"
        " AS Final_url",
        "market AS Country",
        "currency AS Currency",
        "cast(spend * 1000000 AS bigint) AS Cost_micros",
        "spend AS Spend",
        "cast(impressions AS bigint) AS Impressions",
        "cast(clicks AS bigint) AS Clicks",
        "cast(mult * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.5 ELSE 0.0 END"
        " AS double) AS Conversions",
        "gmv AS Conversion_value",
        "cast(mult * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.5 ELSE 0.0 END"
        " AS double) AS All_conversions",
        "CASE WHEN ver = 3 THEN 'LAST_CLICK' ELSE 'DATA_DRIVEN' END AS Attribution_model",
        *_lineage("google_ads_api"),
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["google_ads_shopee_daily"].fields] + _landing(b))


def _evc_base(spark, sf_dir, slot, base=None):
    # Conversion APIs report one version per row (no restatements).
    b = base if base is not None else event_base(spark, sf_dir)
    return b.where(f"slot = {slot} AND ver = 1")


def evc_google(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = _evc_base(spark, sf_dir, 7, base).where("event_type = 'purchase'")
    return b.selectExpr(
        "d AS date",
        "concat('cus-', market) AS customer_id",
        "campaign AS campaign_id",
        "concat('Campaign ', campaign) AS campaign_name",
        "element_at(array('SEARCH', 'PMAX', 'SHOPPING', 'DEMAND_GEN', 'VIDEO'),"
        " cast(user_id % 5 AS int) + 1) AS campaign_type",
        "CASE WHEN event_id % 5 = 0 THEN (CASE WHEN user_id % 2 = 0 THEN 'engaged_view'"
        " ELSE 'view_through' END) ELSE 'click_through' END AS ad_event_type",
        "1.0D AS conversions",
        "gmv AS conversions_value",
        "CASE WHEN event_id % 5 <> 0 AND user_id % 3 = 0 THEN 2.0D ELSE 1.0D END AS all_conversions",
        "gmv AS all_conversions_value",
        "'custom_google_ads_api' AS _source_system",
        "market AS _market",
        "concat('acct-', market) AS _accounts",
        f"DATE'{WINDOW_START}' AS _window_start",
        f"DATE'{AS_OF}' AS _window_end",
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["evc_google"].fields] + _landing(b))


def evc_meta(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = _evc_base(spark, sf_dir, 6, base).where("event_type IN ('purchase', 'signup')")
    return b.selectExpr(
        "d AS date",
        "concat('act-', market) AS account_id",
        "campaign AS campaign_id",
        "concat('CPAS ', campaign) AS campaign_name",
        "concat('as-', cast(user_id % 40 AS string)) AS adset_id",
        "CASE WHEN event_id % 5 = 0 THEN '1d_ev' ELSE element_at(array('7d_click', '1d_click', '1d_view'),"
        " cast(user_id % 3 AS int) + 1) END AS attribution_window",
        "CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'add_to_cart' END AS action_type",
        "cast(1 AS bigint) AS action_count",
        "gmv AS action_value",
        "'custom_meta_marketing_api' AS _source_system",
        "market AS _market",
        "concat('acct-', market) AS _accounts",
        f"DATE'{WINDOW_START}' AS _window_start",
        f"DATE'{AS_OF}' AS _window_end",
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["evc_meta"].fields] + _landing(b))


def evc_tiktok(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = _evc_base(spark, sf_dir, 5, base).where("event_type = 'purchase'")
    return b.selectExpr(
        "d AS date",
        "concat('adv-', market) AS advertiser_id",
        "campaign AS campaign_id",
        "concat('ag-', cast(user_id % 40 AS string)) AS adgroup_id",
        "CASE WHEN event_id % 5 = 0 THEN (CASE WHEN user_id % 2 = 0 THEN 'EVTA' ELSE 'VTA' END)"
        " ELSE 'CTA' END AS attribution_type",
        "cast(7 AS bigint) AS attribution_window_days",
        "cast(1 AS bigint) AS conversions",
        "gmv AS conversion_value",
        "'custom_tiktok_ads_api' AS _source_system",
        "market AS _market",
        "concat('acct-', market) AS _accounts",
        f"DATE'{WINDOW_START}' AS _window_start",
        f"DATE'{AS_OF}' AS _window_end",
        "ingest_ts AS ingested_at",
        *_landing(b),
    ).select([f.name for f in RAW_SCHEMAS["evc_tiktok"].fields] + _landing(b))


RAW_BUILDERS = {
    "shopee_orders": shopee_orders,
    "tiktok_shop_orders": tiktok_shop_orders,
    "tiktok_ads_daily": tiktok_ads_daily,
    "shopee_ads_daily": shopee_ads_daily,
    "meta_cpas_daily": meta_cpas_daily,
    "google_ads_shopee_daily": google_ads_shopee_daily,
    "evc_google": evc_google,
    "evc_meta": evc_meta,
    "evc_tiktok": evc_tiktok,
}


def landing_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw feed clustered by ingest day (column ``ingest_date``): few files a
    day, a hot day split across tasks (AQE rebalance). The rows that the feed is
    derived from are shuffled and sorted, not the many and wide fields of the
    feed, which follow from them row by row. Order lines go out sorted by the
    days, with the fields of few values side by side, so they compress better."""
    if name in ("shopee_orders", "tiktok_shop_orders"):
        few = ["order_day", "ship_day", "market_idx", "o_orderstatus", "returned", "l_linenumber", "l_quantity", "dpct", "tpct"]
        rows = order_rows(spark, sf_dir)
        rows = (rows.select(F.to_date(F.expr(f"timestamp_seconds({_CREATE} + {_LAG})")).alias(INGEST_DAY), *few,
                            *[c for c in rows.columns if c not in few])
                .sortWithinPartitions(INGEST_DAY, "order_day", "market_idx"))
        fields, key = order_fields, "o_orderkey"
    else:
        rows = event_rows(spark, sf_dir).withColumn(INGEST_DAY, F.to_date(F.expr(_EVENT_INGEST)))
        fields, key = event_fields, "event_id"
    return RAW_BUILDERS[name](spark, sf_dir, fields(rows.hint("rebalance", INGEST_DAY).sortWithinPartitions(INGEST_DAY, key)))


class Bronze:
    """Lazily built raw feeds for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = RAW_BUILDERS[name](self.spark, self.sf_dir)
        return self._cache[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._cache[name] = df

    def with_feeds(self, **feeds: DataFrame) -> "Bronze":
        """A copy in which some feeds are replaced."""
        out = Bronze(self.spark, self.sf_dir)
        out._cache = {**self._cache, **feeds}
        return out


def test_calendar(spark: SparkSession) -> DataFrame:
    from .seeds import CALENDAR_EVENTS, calendar_events
    return calendar_events(spark, list(CALENDAR_EVENTS) + [e[:5] for e in TEST_EVENTS])


def test_fx(spark: SparkSession) -> DataFrame:
    from .seeds import fx_rates
    return fx_rates(spark, FX_START, FX_END, missing=FX_MISSING)
