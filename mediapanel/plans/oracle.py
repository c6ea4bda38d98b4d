"""DuckDB oracle: the same chain written as plain SQL over the driver tables.

Each fragment is a named CTE with its dependencies; ``sql(final, *names)``
assembles ``WITH`` clauses in dependency order. The oracle is independent of
the Spark code: it re-derives the bronze feeds from ``lineitem``, ``orders``,
``customer`` and ``events`` and recomputes every stage.
"""

from __future__ import annotations

import datetime as dt

from ..sources import bind, seeds

MK = "['" + "', '".join(seeds.MARKET_CODES) + "']"
CUR = "['IDR', 'THB', 'VND', 'MYR', 'SGD', 'PHP']"
AS_OF = bind.AS_OF
WS = bind.WINDOW_START


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, dt.date):
            return f"DATE '{v.isoformat()}'"
        return "'" + str(v).replace("'", "''") + "'"
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES\n    {body}) AS t({', '.join(cols)})"


def _calendar_rows():
    out = []
    for (name, kind, start, end, markets, *_) in list(seeds.CALENDAR_EVENTS) + list(bind.TEST_EVENTS):
        d = start
        while d <= end:
            for m in (markets or seeds.MARKET_CODES):
                out.append((d, m, name, kind))
            d += dt.timedelta(days=1)
    return out


F: dict[str, tuple[list[str], str]] = {}


def frag(name, deps, body):
    F[name] = (deps, body)


# ---------------------------------------------------------------- seeds
frag("dim_market", [], _values(seeds.MARKETS, ["market", "country_name", "timezone", "currency"]))
frag("taxonomy", [], _values([(c, lbl, p, g, pr, i) for i, (c, lbl, p, g, pr) in enumerate(seeds.CHANNELS)],
                             ["channel", "label", "platform", "grp", "priority", "tax_order"]))
frag("traffic_map", [], _values(seeds.TRAFFIC_SOURCES, ["platform", "raw_value", "canonical"]))
frag("fx", [], f"""
SELECT cast(d AS date) AS date, r.currency, cast(r.usd_rate AS decimal(12,6)) AS usd_rate
FROM generate_series(DATE '{bind.FX_START}', DATE '{bind.FX_END}', INTERVAL 1 DAY) g(d)
CROSS JOIN ({_values(seeds.FX_RATES, ["currency", "usd_rate"])}) r
WHERE NOT (cast(d AS date), r.currency) IN ({', '.join(f"(DATE '{a}', '{b}')" for a, b in bind.FX_MISSING)})
""")
frag("calendar", [], _values(_calendar_rows(), ["date", "market", "event_name", "event_kind"]))
frag("priors", [], _values(seeds.CHANNEL_PRIORS,
                           ["channel", "halflife", "hill_shape", "baseline_roas", "roas_lo", "roas_hi",
                            "cpm", "ctr", "cvr", "voucher_pct", "evc_coverage", "daily_spend"]))

# ---------------------------------------------------------------- bronze: orders
frag("order_base0", [], f"""
SELECT l.*, o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, c.c_nationkey,
  {MK}[c_nationkey % 6 + 1] AS market,
  {CUR}[c_nationkey % 6 + 1] AS mk_currency,
  {bind.EPOCH_2024} + (datediff('day', DATE '1995-01-01', cast(o_orderdate AS date)) % 30) * 86400
    + (o_orderkey * 7919) % 86400 AS create_secs,
  (abs(datediff('day', cast(o_orderdate AS date), cast(l_shipdate AS date))) % 120) * 3600 AS ingest_lag,
  cast(round(l_extendedprice * 100) AS bigint) AS cents,
  cast(round(l_discount * 100) AS bigint) AS dpct,
  cast(round(l_tax * 100) AS bigint) AS tpct,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'returned'
       WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped'
       WHEN o_orderstatus = 'P' THEN 'cancelled' END AS status,
  cast(l_suppkey % 6 AS int) + 1 AS src_idx
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
""")
frag("order_base", ["order_base0"], """
SELECT *,
  CASE WHEN o_orderkey % 101 = 0 THEN 'ZZ' ELSE market END AS country,
  CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 10 = 7 THEN NULL ELSE market END AS market_field,
  CASE WHEN o_orderkey % 101 = 0 THEN 'USD' WHEN o_orderkey % 7 = 3 THEN 'SGD' ELSE mk_currency END AS currency,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds(create_secs) AS create_ts,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds(create_secs + ingest_lag) AS ingest_ts,
  cast(cast(cents * (100 - dpct) AS decimal(38,0)) / 10000 AS decimal(18,4)) AS subtotal
FROM order_base0
""")
frag("raw_shopee_orders", ["order_base"], """
SELECT cast(create_ts AS date) AS "Date", 'SO' || cast(o_orderkey AS varchar) AS Order_sn,
  upper(status) AS Order_status, create_ts AS Create_time,
  'shop-' || cast(l_suppkey AS varchar) AS Shop_id, country AS Country,
  'SKU-' || cast(l_linenumber AS varchar) AS Sku, 'item-' || cast(l_partkey AS varchar) AS Item_id,
  cast(l_quantity AS bigint) AS Quantity, subtotal AS Merchandise_subtotal, currency AS Currency,
  ['Organic', 'search', 'FEED', 'recommendation', 'ads', 'livestream'][src_idx] AS Traffic_source,
  market_field AS _market, ingest_ts AS ingested_at
FROM order_base WHERE o_orderkey % 2 = 0
""")
frag("raw_tiktok_shop_orders", ["order_base"], """
SELECT cast(create_ts AS date) AS "Date", 'TT' || cast(o_orderkey AS varchar) AS Order_id,
  CASE status WHEN 'completed' THEN 'Completed' WHEN 'shipped' THEN 'Shipped'
    WHEN 'cancelled' THEN 'Canceled' WHEN 'returned' THEN 'Returned' END AS Order_status,
  create_ts AS Order_create_time, country AS Buyer_country,
  'shop-' || cast(l_suppkey AS varchar) AS Shop_id, 'SKU-' || cast(l_linenumber AS varchar) AS Sku_id,
  'item-' || cast(l_partkey AS varchar) AS Product_id, cast(l_quantity AS bigint) AS Quantity,
  subtotal AS Sub_total, cast(subtotal + cast(tpct AS decimal(18,4)) AS decimal(18,4)) AS Order_amount,
  currency AS Currency, cast(tpct AS decimal(18,4)) AS Shipping_fee,
  ['LIVE', 'VIDEO', 'PRODUCT_CARD', 'SEARCH', 'MALL', 'Showcase'][src_idx] AS Order_source,
  market_field AS _market, ingest_ts AS ingested_at
FROM order_base WHERE o_orderkey % 2 = 1
""")

# ---------------------------------------------------------------- bronze: events
frag("event_base0", [], f"""
SELECT event_id, ts, user_id, event_type, value,
  {MK}[event_id % 6 + 1] AS market, {CUR}[event_id % 6 + 1] AS currency,
  cast((event_id // 6) % 8 AS int) AS slot, cast(ts AS date) AS d,
  cast(round(value * 100) AS bigint) AS cents,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE {MK}[event_id % 6 + 1] END AS market_field
FROM events WHERE event_type <> 'error'
""")
frag("event_base", ["event_base0"], """
SELECT *,
  mult * CASE event_type WHEN 'view' THEN 100 WHEN 'click' THEN 10 ELSE 1 END AS impressions,
  mult * CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 10 ELSE 1 END AS clicks,
  mult * CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS orders,
  mult * CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS atc,
  cast(cast(CASE WHEN event_type IN ('view', 'click') THEN mult * cents ELSE 0 END AS decimal(38,0)) / 10
       AS decimal(18,4)) AS spend,
  cast(cast(CASE WHEN event_type = 'purchase' THEN mult * cents * 3 ELSE 0 END AS decimal(38,0)) / 100
       AS decimal(18,4)) AS gmv,
  'cmp-' || cast(user_id % 20 AS varchar) AS campaign
FROM (
  SELECT *, 1 AS ver, 1 AS mult, ts + INTERVAL 1 HOUR AS ingest_ts FROM event_base0
  UNION ALL
  SELECT *, 2 AS ver, 2 AS mult, ts + INTERVAL 1 DAY AS ingest_ts FROM event_base0 WHERE event_id % 7 = 0
  UNION ALL
  SELECT *, 3 AS ver, 1 AS mult, ts + INTERVAL 1 HOUR AS ingest_ts FROM event_base0 WHERE event_id % 13 = 0
) v
""")
frag("raw_tiktok_ads", ["event_base"], """
SELECT d AS "Date", 'adv-' || market AS Advertiser_id, campaign AS Campaign_id,
  ['VIDEO_SHOPPING', 'LIVE_SHOPPING', 'PRODUCT_CATALOG_SALES', 'SEARCH_ADS',
   CASE WHEN event_id % 2 = 0 THEN 'TRAFFIC' ELSE 'REACH' END][user_id % 5 + 1]
    AS Objective_type,
  CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'ag-' || cast(user_id % 40 AS varchar) END AS Ad_group_id,
  'ad-' || cast(event_id AS varchar) AS Ad_id, market AS Country_code, currency AS Currency,
  spend AS Spend, cast(impressions AS bigint) AS Impressions, cast(clicks AS bigint) AS Clicks,
  cast(CASE WHEN event_type = 'view' THEN 20 * mult ELSE 0 END AS bigint) AS Video_play_6s,
  cast(orders AS bigint) AS Complete_payment, gmv AS Complete_payment_value,
  CASE WHEN ver = 3 THEN '1d_click' ELSE '7d_click' END AS Conversion_attribution_window, market_field AS _market, ingest_ts AS ingested_at
FROM event_base WHERE slot = 5
""")
frag("raw_shopee_ads", ["event_base"], """
SELECT d AS "Date", 'shop-' || market AS Shop_id, market AS Country, currency AS Currency,
  ['Product_Search', 'shop_search', 'TARGETING', 'gmv_max', 'Affiliate'][slot + 1] AS Ad_type,
  campaign AS Campaign_id,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'SKU-' || cast(user_id % 7 AS varchar) END AS Sku_id,
  'kw-' || cast(event_id AS varchar) AS Keyword,
  spend AS Spend, cast(spend * 0.15 AS decimal(18,4)) AS Voucher_subsidy,
  cast(impressions AS bigint) AS Impressions, cast(clicks AS bigint) AS Clicks,
  cast(CASE WHEN user_id % 5 < 3 THEN orders ELSE 0 END AS bigint) AS Direct_orders,
  cast(orders AS bigint) AS Broad_orders, cast(gmv * 0.6 AS decimal(18,4)) AS Direct_gmv,
  gmv AS Broad_gmv, CASE WHEN ver = 3 THEN '1d' ELSE '7d' END AS Attribution_window, market_field AS _market, ingest_ts AS ingested_at
FROM event_base WHERE slot < 5
""")
frag("raw_meta", ["event_base"], """
SELECT d AS "Date", 'act-' || market AS Account_id, campaign AS Campaign_id,
  'as-' || cast(user_id % 40 AS varchar) AS Adset_id, 'ad-' || cast(event_id AS varchar) AS Ad_id,
  CASE WHEN user_id % 10 = 9 THEN 'CONVERSIONS' ELSE 'PRODUCT_CATALOG_SALES' END AS Objective,
  'cat-' || market AS Catalog_id, market AS Country, currency AS Currency, spend AS Spend,
  cast(impressions AS bigint) AS Impressions, cast(clicks AS bigint) AS Link_clicks,
  cast(atc AS bigint) AS Add_to_cart, cast(orders AS bigint) AS Purchase, gmv AS Purchase_value,
  CASE WHEN ver = 3 THEN '1d_click' ELSE '7d_click' END AS Attribution_window, market_field AS _market, ingest_ts AS ingested_at
FROM event_base WHERE slot = 6
""")
frag("raw_google", ["event_base"], """
SELECT d AS "Date", 'cus-' || market AS Customer_id, campaign AS Campaign_id,
  ['Shopee Always On', 'SHP_Brand', 'SHP-Generic', 'Brand Awareness'][user_id % 4 + 1] AS Campaign_name,
  ['SEARCH', 'PMAX', 'SHOPPING', 'DEMAND_GEN', 'VIDEO'][user_id % 5 + 1] AS Campaign_type,
  'ag-' || cast(user_id % 40 AS varchar) AS Ad_group_id, 'kw-' || cast(event_id AS varchar) AS Keyword,
  ['https://shopee.co.id/shop', 'https://www.example.com/', 'https://mall.shopee.sg/p',
   'https://www.example.com/lp'][user_id % 4 + 1] AS Final_url,
  market AS Country, currency AS Currency, spend AS Spend,
  cast(impressions AS bigint) AS Impressions, cast(clicks AS bigint) AS Clicks,
  cast(mult * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.5 ELSE 0.0 END AS double)
    AS Conversions,
  gmv AS Conversion_value, CASE WHEN ver = 3 THEN 'LAST_CLICK' ELSE 'DATA_DRIVEN' END AS Attribution_model, market_field AS _market,
  ingest_ts AS ingested_at
FROM event_base WHERE slot = 7
""")
frag("raw_evc_google", ["event_base"], """
SELECT d AS date, market AS _market,
  CASE WHEN event_id % 5 = 0 THEN (CASE WHEN user_id % 2 = 0 THEN 'engaged_view' ELSE 'view_through' END)
       ELSE 'click_through' END AS ad_event_type,
  1.0::double AS conversions, gmv AS conversions_value,
  CASE WHEN event_id % 5 <> 0 AND user_id % 3 = 0 THEN 2.0 ELSE 1.0 END::double AS all_conversions,
  gmv AS all_conversions_value, 'custom_google_ads_api' AS _source_system
FROM event_base WHERE slot = 7 AND ver = 1 AND event_type = 'purchase'
""")
frag("raw_evc_meta", ["event_base"], """
SELECT d AS date, market AS _market,
  CASE WHEN event_id % 5 = 0 THEN '1d_ev' ELSE ['7d_click', '1d_click', '1d_view'][user_id % 3 + 1] END
    AS attribution_window,
  CASE WHEN event_type = 'purchase' THEN 'purchase' ELSE 'add_to_cart' END AS action_type,
  cast(1 AS bigint) AS action_count, gmv AS action_value, 'custom_meta_marketing_api' AS _source_system
FROM event_base WHERE slot = 6 AND ver = 1 AND event_type IN ('purchase', 'signup')
""")
frag("raw_evc_tiktok", ["event_base"], """
SELECT d AS date, market AS _market,
  CASE WHEN event_id % 5 = 0 THEN (CASE WHEN user_id % 2 = 0 THEN 'EVTA' ELSE 'VTA' END) ELSE 'CTA' END
    AS attribution_type,
  cast(1 AS bigint) AS conversions, gmv AS conversion_value, 'custom_tiktok_ads_api' AS _source_system
FROM event_base WHERE slot = 5 AND ver = 1 AND event_type = 'purchase'
""")

# ---------------------------------------------------------------- silver
frag("stg_sales_union", ["raw_shopee_orders", "raw_tiktok_shop_orders", "traffic_map"], """
SELECT 'shopee' AS platform, coalesce(so._market, so.Country) AS market, so.Shop_id AS shop_id,
  so.Sku AS sku_id, so.Item_id AS item_id, so.Order_sn AS order_id, lower(so.Order_status) AS order_status,
  so.Create_time AS create_time_utc, so.Quantity AS quantity, so.Merchandise_subtotal AS gmv_local,
  so.Currency AS currency, coalesce(st.canonical, lower(so.Traffic_source)) AS traffic_source,
  so.ingested_at
FROM raw_shopee_orders so
LEFT JOIN traffic_map st ON st.platform = 'shopee' AND st.raw_value = lower(so.Traffic_source)
UNION ALL
SELECT 'tiktok_shop', coalesce(t._market, t.Buyer_country), t.Shop_id, t.Sku_id, t.Product_id, t.Order_id,
  lower(t.Order_status), t.Order_create_time, t.Quantity, t.Order_amount, t.Currency,
  coalesce(st.canonical, lower(t.Order_source)), t.ingested_at
FROM raw_tiktok_shop_orders t
LEFT JOIN traffic_map st ON st.platform = 'tiktok_shop' AND st.raw_value = t.Order_source
""")
frag("stg_platform_sales", ["stg_sales_union", "dim_market"], """
SELECT d.platform, d.market, d.shop_id, d.sku_id, d.item_id, d.order_id, d.order_status,
  cast(timezone(dm.timezone, timezone('UTC', d.create_time_utc)) AS date) AS date_local,
  d.create_time_utc, d.quantity, d.gmv_local, d.currency, d.traffic_source,
  d.order_status IN ('cancelled', 'canceled', 'returned', 'failed', 'refunded') AS is_cancelled,
  d.order_status IN ('completed', 'delivered', 'shipped') AS is_completed,
  d.ingested_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY platform, order_id, sku_id ORDER BY
    ingested_at DESC NULLS LAST, item_id DESC NULLS LAST, shop_id DESC NULLS LAST,
    gmv_local DESC NULLS LAST, quantity DESC NULLS LAST, order_status DESC NULLS LAST,
    traffic_source DESC NULLS LAST, create_time_utc DESC NULLS LAST, market DESC NULLS LAST,
    currency DESC NULLS LAST) AS rn
  FROM stg_sales_union
) d LEFT JOIN dim_market dm ON dm.market = d.market
WHERE d.rn = 1
""")
frag("stg_onplatform_ads", ["raw_tiktok_ads", "raw_shopee_ads", "fx"], """
SELECT u.platform, u.market, u.ad_type, u.objective, u.campaign_id, u.ad_group_id, u.sku_id, u.ad_key,
  u.currency, u.spend_local, cast(u.spend_local AS double) / cast(fx.usd_rate AS double) AS spend_usd,
  u.impressions, u.clicks, u.video_views_2s_or_6s, u.direct_orders, u.broad_orders,
  u.direct_gmv_local, u.broad_gmv_local,
  cast(u.direct_gmv_local AS double) / cast(fx.usd_rate AS double) AS direct_gmv_usd,
  cast(u.broad_gmv_local AS double) / cast(fx.usd_rate AS double) AS broad_gmv_usd,
  u.attribution_window, u.date_report AS date_local, u.ingested_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY platform, date_report, market, campaign_id, ad_group_id,
      sku_id, ad_type, ad_key ORDER BY ingested_at DESC NULLS LAST, spend_local DESC NULLS LAST,
      impressions DESC NULLS LAST, clicks DESC NULLS LAST, direct_gmv_local DESC NULLS LAST,
      broad_gmv_local DESC NULLS LAST, direct_orders DESC NULLS LAST, objective DESC NULLS LAST,
      ad_key DESC NULLS LAST, broad_orders DESC NULLS LAST, video_views_2s_or_6s DESC NULLS LAST,
      currency DESC NULLS LAST, attribution_window DESC NULLS LAST) AS rn
  FROM (
    SELECT 'tiktok_ads' AS platform, coalesce(_market, Country_code) AS market,
      CASE WHEN lower(Objective_type) LIKE '%video%' THEN 'video'
           WHEN lower(Objective_type) LIKE '%live%' THEN 'live'
           WHEN lower(Objective_type) LIKE '%catalog%' THEN 'catalog'
           WHEN lower(Objective_type) LIKE '%search%' THEN 'search' ELSE 'other' END AS ad_type,
      Objective_type AS objective, Campaign_id AS campaign_id, Ad_group_id AS ad_group_id,
      CAST(NULL AS varchar) AS sku_id, Ad_id AS ad_key, Currency AS currency, Spend AS spend_local,
      Impressions AS impressions, Clicks AS clicks, Video_play_6s AS video_views_2s_or_6s,
      Complete_payment AS direct_orders, CAST(NULL AS bigint) AS broad_orders,
      Complete_payment_value AS direct_gmv_local, CAST(NULL AS decimal(18,4)) AS broad_gmv_local,
      Conversion_attribution_window AS attribution_window, "Date" AS date_report, ingested_at
    FROM raw_tiktok_ads
    UNION ALL
    SELECT 'shopee_ads', coalesce(_market, Country), lower(Ad_type), CAST(NULL AS varchar), Campaign_id,
      CAST(NULL AS varchar), Sku_id, Keyword, Currency,
      cast(greatest(coalesce(Spend, 0) - coalesce(Voucher_subsidy, 0), 0) AS decimal(18,4)),
      Impressions, Clicks, CAST(NULL AS bigint), Direct_orders, Broad_orders, Direct_gmv, Broad_gmv,
      Attribution_window, "Date", ingested_at
    FROM raw_shopee_ads
  ) x
) u LEFT JOIN fx ON fx.date = u.date_report AND fx.currency = u.currency
WHERE u.rn = 1
""")
frag("stg_offplatform_ads", ["raw_meta", "raw_google", "fx"], """
SELECT u.platform, u.market, u.destination_platform, u.campaign_id, u.ad_set_or_ad_group_id,
  u.campaign_type, u.catalog_id, u.ad_key, u.currency, u.spend_local,
  cast(u.spend_local AS double) / cast(fx.usd_rate AS double) AS spend_usd,
  u.impressions, u.clicks, u.add_to_cart, u.purchases_reported, u.purchase_value_reported_local,
  cast(u.purchase_value_reported_local AS double) / cast(fx.usd_rate AS double) AS purchase_value_reported_usd,
  u.attribution_window, u.date_report AS date_local, u.ingested_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY platform, date_report, market, campaign_id,
      ad_set_or_ad_group_id, ad_key ORDER BY ingested_at DESC NULLS LAST, spend_local DESC NULLS LAST,
      impressions DESC NULLS LAST, clicks DESC NULLS LAST, purchases_reported DESC NULLS LAST,
      purchase_value_reported_local DESC NULLS LAST, campaign_type DESC NULLS LAST,
      catalog_id DESC NULLS LAST, ad_key DESC NULLS LAST, add_to_cart DESC NULLS LAST,
      destination_platform DESC NULLS LAST, currency DESC NULLS LAST, attribution_window DESC NULLS LAST) AS rn
  FROM (
    SELECT 'meta_cpas' AS platform, coalesce(_market, Country) AS market, 'shopee' AS destination_platform,
      Campaign_id AS campaign_id, Adset_id AS ad_set_or_ad_group_id, 'catalog_sales' AS campaign_type,
      Catalog_id AS catalog_id, Ad_id AS ad_key, Currency AS currency, Spend AS spend_local,
      Impressions AS impressions, Link_clicks AS clicks, Add_to_cart AS add_to_cart,
      Purchase AS purchases_reported, Purchase_value AS purchase_value_reported_local,
      Attribution_window AS attribution_window, "Date" AS date_report, ingested_at
    FROM raw_meta WHERE upper(Objective) LIKE '%CATALOG%'
    UNION ALL
    SELECT 'google_ads_shopee', coalesce(_market, Country), 'shopee', Campaign_id, Ad_group_id,
      Campaign_type, CAST(NULL AS varchar), Keyword, Currency, Spend, Impressions, Clicks,
      CAST(NULL AS bigint), cast(round(Conversions) AS bigint), Conversion_value, Attribution_model,
      "Date", ingested_at
    FROM raw_google
    WHERE regexp_matches(lower(coalesce(Final_url, '')), '^https?://([a-z]+\\.)?shopee\\.')
       OR regexp_matches(upper(coalesce(Campaign_name, '')), '^SHP[_-]')
  ) x
) u LEFT JOIN fx ON fx.date = u.date_report AND fx.currency = u.currency
WHERE u.rn = 1
""")
frag("stg_evc", ["raw_evc_google", "raw_evc_meta", "raw_evc_tiktok"], """
SELECT date_local, market, channel, attribution_bucket, sum(c) AS conversions,
  sum(v) AS conversion_value_local, min(_source_system) AS _source_system
FROM (
  SELECT date AS date_local, _market AS market, 'google_ads_shopee' AS channel,
    CASE ad_event_type WHEN 'engaged_view' THEN 'evc' WHEN 'view_through' THEN 'evc' ELSE 'click' END
      AS attribution_bucket, cast(conversions AS double) AS c, conversions_value AS v, _source_system
  FROM raw_evc_google
  UNION ALL
  SELECT date, _market, 'meta_cpas',
    CASE attribution_window WHEN '1d_ev' THEN 'evc' WHEN '1d_view' THEN 'evc' ELSE 'click' END,
    cast(action_count AS double), action_value, _source_system
  FROM raw_evc_meta WHERE action_type = 'purchase'
  UNION ALL
  SELECT date, _market, 'tiktok_ads',
    CASE attribution_type WHEN 'EVTA' THEN 'evc' WHEN 'VTA' THEN 'evc' ELSE 'click' END,
    cast(conversions AS double), conversion_value, _source_system
  FROM raw_evc_tiktok
) u
GROUP BY date_local, market, channel, attribution_bucket
""")

# ---------------------------------------------------------------- gold
frag("fact_sales_l1", ["stg_platform_sales"], """
SELECT date_local, market, platform, shop_id, sku_id, traffic_source, cast(count(*) AS bigint) AS cnt
FROM stg_platform_sales WHERE date_local IS NOT NULL
GROUP BY ALL
""")
frag("fact_sales_rows", ["stg_platform_sales", "fx"], """
SELECT s.*, fx.usd_rate, first_value(s.currency) OVER w AS key_currency, first_value(fx.usd_rate) OVER w AS key_rate
FROM stg_platform_sales s LEFT JOIN fx ON fx.date = s.date_local AND fx.currency = s.currency
WHERE s.date_local IS NOT NULL
WINDOW w AS (PARTITION BY s.date_local, s.market, s.platform, s.shop_id, s.sku_id
             ORDER BY s.ingested_at DESC, s.currency DESC)
""")
frag("fact_sales_money", ["fact_sales_rows"], """
SELECT date_local, market, platform, shop_id, sku_id, key_currency AS currency,
  CASE WHEN count(*) = count(gross) THEN sum(gross) END AS gmv_gross_local,
  CASE WHEN count(*) = count(net) THEN sum(net) END AS gmv_net_local,
  CASE WHEN count(*) = count(usd) THEN sum(usd) END AS gmv_net_usd,
  cast(sum(n) AS bigint) AS orders_gross, cast(sum(n_cancelled) AS bigint) AS orders_cancelled
FROM (
  SELECT date_local, market, platform, shop_id, sku_id, key_currency, count(*) AS n, count_if(is_cancelled) AS n_cancelled,
    cast(CASE WHEN currency = key_currency THEN sum(gmv_local)
         ELSE round(cast(cast(sum(gmv_local) AS double) / cast(any_value(usd_rate) AS double)
                         * cast(any_value(key_rate) AS double) AS decimal(38,10)), 4) END AS decimal(28,4)) AS gross,
    cast(CASE WHEN currency = key_currency THEN sum(CASE WHEN is_cancelled THEN 0 ELSE gmv_local END)
         ELSE round(cast(cast(sum(CASE WHEN is_cancelled THEN 0 ELSE gmv_local END) AS double)
                         / cast(any_value(usd_rate) AS double) * cast(any_value(key_rate) AS double) AS decimal(38,10)), 4) END
      AS decimal(28,4)) AS net,
    cast(sum(CASE WHEN is_cancelled THEN 0 ELSE gmv_local END) AS double) / cast(any_value(usd_rate) AS double) AS usd
  FROM fact_sales_rows GROUP BY date_local, market, platform, shop_id, sku_id, key_currency, currency) x
GROUP BY date_local, market, platform, shop_id, sku_id, key_currency
""")
frag("fact_platform_sales", ["fact_sales_money", "fact_sales_l1"], """
SELECT m.*, m.orders_gross - m.orders_cancelled AS orders_net, t.traffic_source_mix
FROM fact_sales_money m JOIN (
  SELECT date_local, market, platform, shop_id, sku_id,
    to_json(list(struct_pack(traffic_source := traffic_source, cnt := cnt)
                 ORDER BY traffic_source NULLS FIRST)) AS traffic_source_mix
  FROM fact_sales_l1 GROUP BY ALL
) t ON t.date_local = m.date_local AND t.market IS NOT DISTINCT FROM m.market AND t.platform = m.platform
  AND t.shop_id IS NOT DISTINCT FROM m.shop_id AND t.sku_id IS NOT DISTINCT FROM m.sku_id
""")


def _keyed_fact(stg: str, key: list[str], attrs: list[str], sums: list[str]) -> str:
    """Sums per key, attributes of the key's latest staged row."""
    last = ", ".join(["ingested_at DESC NULLS LAST"] + [f"{a} DESC NULLS LAST" for a in attrs])
    return f"""
SELECT {', '.join(key)},
  {', '.join(f"max(CASE WHEN rn = 1 THEN {a} END) AS {a}" for a in attrs)},
  {', '.join(f"sum({c}) AS {c}" if c.endswith(('_local', '_usd')) else f"cast(sum({c}) AS bigint) AS {c}" for c in sums)}
FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {last}) AS rn
      FROM {stg} WHERE date_local IS NOT NULL) x
GROUP BY {', '.join(key)}
"""


frag("fact_onplatform_ads", ["stg_onplatform_ads"], _keyed_fact(
    "stg_onplatform_ads",
    ["date_local", "market", "platform", "ad_type", "campaign_id", "ad_group_id", "sku_id"],
    ["objective", "attribution_window", "currency"],
    ["spend_local", "spend_usd", "impressions", "clicks", "video_views_2s_or_6s", "direct_orders", "broad_orders",
     "direct_gmv_local", "broad_gmv_local", "direct_gmv_usd", "broad_gmv_usd"]))
frag("fact_offplatform_ads", ["stg_offplatform_ads"], _keyed_fact(
    "stg_offplatform_ads", ["date_local", "market", "platform", "campaign_id", "ad_set_or_ad_group_id"],
    ["destination_platform", "campaign_type", "catalog_id", "attribution_window", "currency"],
    ["spend_local", "spend_usd", "impressions", "clicks", "add_to_cart", "purchases_reported",
     "purchase_value_reported_local", "purchase_value_reported_usd"]))
frag("fact_evc", ["stg_evc", "dim_market", "fx"], """
SELECT s.date_local, s.market, s.channel, s.attribution_bucket, sum(s.conversions) AS conversions,
  sum(s.conversion_value_local) AS conversion_value_local,
  cast(sum(s.conversion_value_local) AS double) / cast(max(fx.usd_rate) AS double) AS conversion_value_usd,
  min(dm.currency) AS currency
FROM stg_evc s LEFT JOIN dim_market dm ON dm.market = s.market
LEFT JOIN fx ON fx.date = s.date_local AND fx.currency = dm.currency
WHERE s.date_local IS NOT NULL
GROUP BY s.date_local, s.market, s.channel, s.attribution_bucket
""")
frag("platform_totals", ["fact_platform_sales"], """
SELECT date_local, market, platform, cast(sum(orders_net) AS bigint) AS platform_total_orders,
  sum(gmv_net_usd) AS platform_total_gmv_usd
FROM fact_platform_sales GROUP BY date_local, market, platform
""")
frag("panel", ["platform_totals", "fact_onplatform_ads", "fact_offplatform_ads", "calendar"], """
SELECT u.date_local, u.market, u.channel, u.anchor_platform AS platform,
  coalesce(u.spend_usd, 0) AS spend_usd, u.impressions, u.clicks, u.ads_attributed_orders,
  u.ads_attributed_gmv_usd, u.direct_gmv_usd, u.broad_gmv_usd,
  pt.platform_total_orders, pt.platform_total_gmv_usd,
  dayofweek(u.date_local) IN (0, 6) AS is_weekend,
  day(u.date_local) IN (1, 15, 16) AS is_payday,
  ce.date IS NOT NULL AS is_mega_sale,
  cast(strftime(u.date_local, '%W') AS bigint) AS week_of_year
FROM (
  SELECT date_local, market,
    CASE WHEN platform = 'tiktok_ads' THEN 'tiktok_ads'
         WHEN platform = 'shopee_ads' AND ad_type = 'product_search' THEN 'shopee_ads_product_search'
         WHEN platform = 'shopee_ads' AND ad_type = 'shop_search' THEN 'shopee_ads_shop_search'
         WHEN platform = 'shopee_ads' AND ad_type = 'targeting' THEN 'shopee_ads_targeting'
         WHEN platform = 'shopee_ads' AND ad_type = 'gmv_max' THEN 'shopee_ads_gmv_max'
         WHEN platform = 'shopee_ads' AND ad_type = 'affiliate' THEN 'shopee_ads_affiliate'
         ELSE platform || '_other' END AS channel,
    CASE WHEN platform = 'tiktok_ads' THEN 'tiktok_shop' ELSE 'shopee' END AS anchor_platform,
    sum(spend_usd) AS spend_usd, cast(sum(impressions) AS bigint) AS impressions, cast(sum(clicks) AS bigint) AS clicks,
    sum(coalesce(broad_orders, direct_orders)) AS ads_attributed_orders,
    sum(coalesce(broad_gmv_usd, direct_gmv_usd)) AS ads_attributed_gmv_usd,
    sum(direct_gmv_usd) AS direct_gmv_usd,
    sum(CASE WHEN platform = 'tiktok_ads' THEN coalesce(broad_gmv_usd, direct_gmv_usd)
             ELSE broad_gmv_usd END) AS broad_gmv_usd
  FROM fact_onplatform_ads GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT date_local, market, platform, destination_platform, sum(spend_usd),
    cast(sum(impressions) AS bigint), cast(sum(clicks) AS bigint), cast(sum(purchases_reported) AS bigint),
    sum(purchase_value_reported_usd),
    sum(purchase_value_reported_usd), sum(purchase_value_reported_usd)
  FROM fact_offplatform_ads GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT date_local, market,
    CASE WHEN platform = 'shopee' THEN 'shopee_organic' WHEN platform = 'tiktok_shop'
         THEN 'tiktok_shop_organic' ELSE platform || '_organic' END, platform, 0.0,
    NULL, NULL, NULL, NULL, NULL, NULL
  FROM platform_totals
) u
LEFT JOIN platform_totals pt ON pt.date_local = u.date_local AND pt.market = u.market
  AND pt.platform = u.anchor_platform
LEFT JOIN (SELECT DISTINCT date, market FROM calendar) ce ON ce.date = u.date_local AND ce.market = u.market
""")
frag("evc_pivot", ["fact_evc"], """
SELECT date_local, market, channel,
  sum(CASE WHEN attribution_bucket = 'click' THEN conversions ELSE 0 END) AS reported_conversions,
  sum(CASE WHEN attribution_bucket = 'evc' THEN conversions ELSE 0 END) AS evc_conversions,
  sum(CASE WHEN attribution_bucket = 'click' THEN conversion_value_usd ELSE 0 END) AS reported_value_usd,
  sum(CASE WHEN attribution_bucket = 'evc' THEN conversion_value_usd ELSE 0 END) AS evc_value_usd
FROM fact_evc GROUP BY 1, 2, 3
""")
frag("panel_evc", ["panel", "evc_pivot"], """
SELECT p.date_local, p.market, p.channel, p.platform, p.spend_usd, p.impressions, p.clicks,
  p.ads_attributed_orders, p.ads_attributed_gmv_usd, p.ads_attributed_gmv_usd AS reported_gmv_usd,
  p.direct_gmv_usd, p.broad_gmv_usd, coalesce(e.evc_value_usd, 0) AS evc_gmv_usd,
  p.ads_attributed_gmv_usd + coalesce(e.evc_value_usd, 0) AS all_gmv_usd,
  coalesce(e.reported_conversions, cast(p.ads_attributed_orders AS double)) AS reported_conversions,
  coalesce(e.evc_conversions, 0) AS evc_conversions,
  coalesce(e.reported_conversions, cast(p.ads_attributed_orders AS double)) + coalesce(e.evc_conversions, 0)
    AS all_conversions,
  p.platform_total_orders, p.platform_total_gmv_usd, p.is_weekend, p.is_payday, p.is_mega_sale,
  p.week_of_year
FROM panel p LEFT JOIN evc_pivot e ON e.date_local = p.date_local AND e.market = p.market
  AND e.channel = p.channel
""")


def variant(suffix: str, overrides: dict[str, str], names: list[str]) -> None:
    """Copies of ``names`` and of what they depend on, named ``<name>_<suffix>``,
    that read the bodies in ``overrides`` in place of the fragments of those
    names. Fragments that no override reaches are shared."""
    import re
    reached: dict[str, bool] = {}

    def visit(n: str) -> bool:
        if n not in reached:
            deps, body = F[n]
            hits = [d for d in deps if visit(d)]
            reached[n] = n in overrides or bool(hits)
            if n in overrides:
                frag(f"{n}_{suffix}", deps + [n], overrides[n])
            elif hits:
                for d in hits:
                    body = re.sub(rf"\b(FROM|JOIN) {d}\b", rf"\1 {d}_{suffix}", body)
                frag(f"{n}_{suffix}", [f"{d}_{suffix}" if d in hits else d for d in deps], body)
        return reached[n]

    for n in names:
        visit(n)


def sql(final: str, *names: str) -> str:
    """Assemble ``WITH`` clauses for ``names`` (and their dependencies)."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in F[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    final = final.strip()
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS (\n{F[n][1].strip()}\n)" for n in order)
    if final[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{final[5:]}"
    return f"WITH {ctes}\n{final}"
