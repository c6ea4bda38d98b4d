"""Registered media-response queries (M1-M12, PF18) with DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import response as R
from ..sources import bind, seeds
from . import oracle as O
from .chain import Chain
from .registry import _r4, r4, register
from .registry_analytics import PAID_SQL

frag = O.frag


def _event_day_rows():
    out = []
    for (name, kind, start, end, markets, uplift) in bind.TEST_EVENTS:
        d = start
        while d <= end:
            for m in (markets or seeds.MARKET_CODES):
                out.append((d, m, uplift))
            d += dt.timedelta(days=1)
    return out


DOW_SQL = "[" + ", ".join(repr(float(dict(seeds.DOW_MULTIPLIER)[n])) for n in R.DOW_ORDER) + "]"
PAYDAY_SQL = ", ".join(str(d) for d in seeds.PAYDAY_DAYS)

frag("series0", ["panel"], f"""
SELECT market, channel, date_local, sum(spend_usd) AS spend FROM panel WHERE channel IN ({PAID_SQL})
GROUP BY market, channel, date_local""")
frag("series", ["series0", "priors"], """
SELECT sp.market, sp.channel, sp.date_local, coalesce(s0.spend, 0) AS spend,
  coalesce(CASE WHEN p.halflife > 0 THEN pow(0.5, 1.0 / p.halflife) ELSE 0 END, 0) AS decay
FROM (SELECT market, channel, cast(unnest(generate_series(min(date_local), max(date_local), INTERVAL 1 DAY)) AS date)
        AS date_local FROM series0 GROUP BY market, channel) sp
LEFT JOIN series0 s0 ON s0.market = sp.market AND s0.channel = sp.channel AND s0.date_local = sp.date_local
LEFT JOIN priors p ON p.channel = sp.channel""")
frag("adstock", ["series"], """
SELECT a.market, a.channel, a.date_local, a.spend, a.decay,
  sum(b.spend * pow(a.decay, datediff('day', b.date_local, a.date_local))) AS adstock
FROM series a JOIN series b ON a.market = b.market AND a.channel = b.channel AND b.date_local <= a.date_local
GROUP BY a.market, a.channel, a.date_local, a.spend, a.decay""")
frag("event_days", [], O._values(_event_day_rows(), ["date_local", "market", "uplift_mult"]))
frag("seasonality", ["panel", "event_days"], f"""
SELECT d.market, d.date_local, {DOW_SQL}[dayofweek(d.date_local) + 1] AS dow_mult,
  coalesce(e.event_mult, 1.0) AS event_mult,
  {DOW_SQL}[dayofweek(d.date_local) + 1] * CASE WHEN day(d.date_local) IN ({PAYDAY_SQL}) THEN {seeds.PAYDAY_UPLIFT}
    ELSE 1.0 END * coalesce(e.event_mult, 1.0) AS multiplier
FROM (SELECT DISTINCT market, date_local FROM panel) d
LEFT JOIN (SELECT date_local, market, product(uplift_mult) AS event_mult FROM event_days GROUP BY 1, 2) e
  ON e.date_local = d.date_local AND e.market = d.market""")


@register("adstock", O.sql(f"""
SELECT market, channel, date_local, {_r4('spend')}, {_r4('adstock')} FROM adstock""", "adstock"))
def q_adstock(c: Chain) -> DataFrame:
    a = R.adstock(c.panel, c.priors)
    return a.select("market", "channel", "date_local", r4("spend"), r4("adstock"))


@register("hill_response", O.sql(f"""
WITH h AS (
  SELECT a.*, p.hill_shape, p.baseline_roas, p.daily_spend,
    pow(greatest(a.adstock, 0), p.hill_shape) / (pow(greatest(a.adstock, 0), p.hill_shape)
      + pow(p.daily_spend / greatest(1e-9, 1 - a.decay), p.hill_shape)) AS sat
  FROM adstock a JOIN priors p ON p.channel = a.channel)
SELECT market, channel, date_local, {_r4('spend')}, {_r4('adstock')}, {_r4('sat', 'saturation')},
  {_r4('sat * 2.0 * baseline_roas * daily_spend', 'response')}
FROM h""", "adstock", "priors"))
def q_hill_response(c: Chain) -> DataFrame:
    h = R.hill_response(c.panel, c.priors)
    return h.select("market", "channel", "date_local", r4("spend"), r4("adstock"), r4("saturation"), r4("response"))


@register("seasonality_mult", O.sql(f"""
SELECT market, date_local, {_r4('dow_mult')}, {_r4('event_mult')}, {_r4('multiplier')} FROM seasonality""",
                                    "seasonality"))
def q_seasonality_mult(c: Chain) -> DataFrame:
    return c.seasonality.select("market", "date_local", r4("dow_mult"), r4("event_mult"), r4("multiplier"))


def _channel_event_rows():
    return [(e[2] + dt.timedelta(days=k), m, ch, e[5]) for e in bind.TEST_CHANNEL_EVENTS
            for k in range((e[3] - e[2]).days + 1) for m in (e[4] or seeds.MARKET_CODES) for ch in e[6]]


frag("channel_event_days", [], O._values(_channel_event_rows(), ["date_local", "market", "channel", "uplift_mult"]))


@register("channel_seasonality", O.sql(f"""
SELECT p.market, p.channel, p.date_local, {_r4('s.dow_mult', 'dow_mult')},
  {_r4('s.event_mult * coalesce(e.mult, 1.0)', 'event_mult')}, {_r4('s.multiplier * coalesce(e.mult, 1.0)', 'multiplier')}
FROM (SELECT DISTINCT market, channel, date_local FROM panel) p
JOIN seasonality s ON s.market = p.market AND s.date_local = p.date_local
LEFT JOIN (SELECT date_local, market, channel, product(uplift_mult) AS mult FROM channel_event_days GROUP BY 1, 2, 3) e
  ON e.date_local = p.date_local AND e.market = p.market AND e.channel = p.channel""",
                                       "panel", "seasonality", "channel_event_days"))
def q_channel_seasonality(c: Chain) -> DataFrame:
    return c.channel_seasonality.select("market", "channel", "date_local", r4("dow_mult"), r4("event_mult"),
                                        r4("multiplier"))


@register("gmv_cap", O.sql(f"""
WITH a AS (SELECT *, sum(ads_attributed_gmv_usd) OVER (PARTITION BY date_local, market, platform) AS ads_total
           FROM panel WHERE ads_attributed_gmv_usd IS NOT NULL),
b AS (SELECT *, coalesce(CASE WHEN ads_total <> 0 THEN (CASE WHEN ads_total > platform_total_gmv_usd * 0.95
        THEN platform_total_gmv_usd * 0.95 / ads_total ELSE 1.0 END) END, 1.0) AS clip_factor FROM a)
SELECT date_local, market, channel, platform, {_r4('ads_attributed_gmv_usd')}, {_r4('ads_total')},
  {_r4('platform_total_gmv_usd')}, {_r4('clip_factor')},
  {_r4('ads_attributed_gmv_usd * clip_factor', 'capped_gmv_usd')},
  {_r4('platform_total_gmv_usd - ads_total * clip_factor', 'organic_gmv_usd')}
FROM b""", "panel"))
def q_gmv_cap(c: Chain) -> DataFrame:
    g = R.gmv_cap(c.panel)
    return g.select("date_local", "market", "channel", "platform", r4("ads_attributed_gmv_usd"), r4("ads_total"),
                    r4("platform_total_gmv_usd"), r4("clip_factor"), r4("capped_gmv_usd"), r4("organic_gmv_usd"))


@register("allocate", O.sql(f"""
WITH w AS ({O._values(R.allocation_shares(), ['family', 'channel', 'slot', 'share'])}),
t AS (SELECT date_local, market, 'google_ads_shopee' AS channel, sum(spend_usd) AS amount, sum(clicks) AS cnt
      FROM panel WHERE channel = 'google_ads_shopee' GROUP BY 1, 2
      UNION ALL
      SELECT date_local, market, 'shopee_ads', sum(spend_usd), sum(clicks) FROM panel
      WHERE starts_with(channel, 'shopee_ads_') GROUP BY 1, 2
      UNION ALL
      SELECT date_local, market, platform, sum(gmv_net_usd), sum(orders_gross) FROM fact_platform_sales GROUP BY 1, 2, 3)
SELECT t.date_local, t.market, w.family, t.channel, w.slot, {_r4('t.amount * cast(w.share AS double)', 'amount')},
  cast(round_even(cast(t.cnt AS double) * cast(w.share AS double), 0) AS bigint) AS cnt
FROM t JOIN w ON w.channel = t.channel""", "panel", "fact_platform_sales"))
def q_allocate(c: Chain) -> DataFrame:
    """Spend and clicks over campaign types and ad types, GMV and order lines
    over traffic sources."""
    def total(df, channel, amount, count):
        return df.groupBy("date_local", "market", channel.alias("channel")).agg(
            F.sum(amount).alias("amount"), F.sum(count).alias("cnt"))
    google = c.panel.where(F.col("channel") == "google_ads_shopee")
    shopee = c.panel.where(F.col("channel").startswith("shopee_ads_"))
    rows = (total(google, F.col("channel"), "spend_usd", "clicks")
            .unionByName(total(shopee, F.lit("shopee_ads"), "spend_usd", "clicks"))
            .unionByName(total(c.fact_platform_sales, F.col("platform"), "gmv_net_usd", "orders_gross")))
    w = R.allocation_weights(c.spark)
    a = R.allocate(rows, w.drop("family"), ["channel"], ["amount"], ["cnt"], "slot", normalize=False)
    # Fixed weight tables: a few rows.
    return a.join(F.broadcast(w.select("family", "channel", "slot")), ["channel", "slot"]).select(
        "date_local", "market", "family", "channel", "slot", r4("amount"), "cnt")


@register("voucher_share", O.sql(f"""
WITH s AS (
  SELECT p.date_local, p.market, p.channel, p.spend_usd, pr.voucher_pct, coalesce(m.multiplier, 1.0) AS mult
  FROM panel p JOIN priors pr ON pr.channel = p.channel AND pr.voucher_pct > 0
  LEFT JOIN seasonality m ON m.market = p.market AND m.date_local = p.date_local),
t AS (SELECT *, least(greatest(voucher_pct * (0.7 + 0.3 * mult / avg(mult) OVER (PARTITION BY market, channel))
        * CASE WHEN mult > 1.8 THEN 1.3 ELSE 1.0 END, 0.0), 0.45) AS pct FROM s)
SELECT date_local, market, channel, {_r4('mult', 'multiplier')}, {_r4('pct', 'voucher_pct')},
  {_r4('spend_usd * pct', 'voucher_usd')}
FROM t""", "panel", "priors", "seasonality"))
def q_voucher_share(c: Chain) -> DataFrame:
    v = R.voucher_share(c.panel, c.priors, c.seasonality)
    return v.select("date_local", "market", "channel", r4("multiplier"), r4("voucher_pct"), r4("voucher_usd"))


GSPLIT = O._values(seeds.GOOGLE_EVC_SPLITS, ["campaign_type", "w_click", "w_evc"])


@register("attribution_split", O.sql(f"""
WITH b AS (SELECT date_local, market, channel, greatest(all_conversions - evc_conversions, 0) AS click_conv,
             evc_conversions AS evc_conv, coalesce(ads_attributed_gmv_usd, 0) AS value FROM panel_evc),
g AS (SELECT b.*, w.* FROM b JOIN ({GSPLIT}) w ON b.channel = 'google_ads_shopee'),
u AS (
  SELECT date_local, market, channel, campaign_type, 'click_through' AS kind, click_conv * w_click AS conversions,
    value * w_click AS value_usd FROM g WHERE click_conv * w_click + evc_conv * w_evc <> 0
  UNION ALL
  SELECT date_local, market, channel, campaign_type, 'engaged_view', evc_conv * w_evc, value * w_evc * 0.6
  FROM g WHERE click_conv * w_click + evc_conv * w_evc <> 0 AND evc_conv * w_evc > 0
  UNION ALL
  SELECT date_local, market, channel, NULL, k.kind, k.cnt, value * k.vs FROM b,
    LATERAL (VALUES ('7d_click', floor(click_conv * 0.8), 0.8), ('1d_click', floor(click_conv * 0.2), 0.2),
                    ('1d_ev', floor(evc_conv), 0.25)) k(kind, cnt, vs)
  WHERE channel = 'meta_cpas' AND k.cnt <> 0
  UNION ALL
  SELECT date_local, market, channel, NULL, k.kind, k.cnt, value * k.vs FROM b,
    LATERAL (VALUES ('CTA', floor(click_conv * 0.95), 0.80),
                    ('VTA', greatest(floor(click_conv) - floor(click_conv * 0.95), 0), 0.05),
                    ('EVTA', floor(evc_conv), 0.15)) k(kind, cnt, vs)
  WHERE channel = 'tiktok_ads' AND k.cnt <> 0)
SELECT date_local, market, channel, campaign_type, kind, {_r4('conversions')}, {_r4('value_usd')} FROM u""",
                                     "panel_evc"))
def q_attribution_split(c: Chain) -> DataFrame:
    a = R.attribution_split(c.panel_evc)
    return a.select("date_local", "market", "channel", "campaign_type", "kind", r4("conversions"), r4("value_usd"))


def _what_if_sql(patches: list[tuple]) -> str:
    """Patches applied one after the other, as the operator folds them."""
    cols = []
    for m in R.WHAT_IF_METRICS:
        expr = f"cast({m} AS double)"
        for ch, mm, op, v in patches:
            if mm == m:
                new = {"set": f"{v}", "mul": f"({expr}) * {v}", "add": f"({expr}) + {v}"}[op]
                expr = f"CASE WHEN channel = '{ch}' THEN {new} ELSE {expr} END"
        cols.append(_r4(expr, m))
    return f"SELECT date_local, market, channel, {', '.join(cols)} FROM scan"


def _what_if(c: Chain, patches: DataFrame) -> DataFrame:
    w = R.what_if(c.scan.select("date_local", "market", "channel", *R.WHAT_IF_METRICS), patches)
    return w.select("date_local", "market", "channel", *[r4(m) for m in R.WHAT_IF_METRICS])


@register("what_if", O.sql(_what_if_sql(seeds.SCENARIOS["competitor_launch"]), "scan"))
def q_what_if(c: Chain) -> DataFrame:
    return _what_if(c, R.scenario_patches(c.spark, "competitor_launch"))


@register("what_if_supply", O.sql(_what_if_sql(seeds.SCENARIOS["supply_shortage"]), "scan"))
def q_what_if_supply(c: Chain) -> DataFrame:
    return _what_if(c, R.scenario_patches(c.spark, "supply_shortage"))


# All three operations; two patches of one metric build on each other.
PATCHES = [("tiktok_ads", "spend_usd", "mul", 2.0), ("tiktok_ads", "spend_usd", "add", 5.0),
           ("tiktok_ads", "clicks", "set", 7.0), ("meta_cpas", "clicks", "add", -1.0),
           ("meta_cpas", "ads_gmv_usd", "add", 10.0), ("meta_cpas", "ads_gmv_usd", "mul", 0.5)]


@register("what_if_patches", O.sql(_what_if_sql(PATCHES), "scan"))
def q_what_if_patches(c: Chain) -> DataFrame:
    return _what_if(c, c.spark.createDataFrame([(i, *x) for i, x in enumerate(PATCHES)],
                                               "seq long, channel string, metric string, op string, value double"))


@register("roas_bands", O.sql(f"""
WITH a AS (SELECT channel, sum(spend_usd) AS spend, sum(coalesce(ads_attributed_gmv_usd, 0)) AS gmv FROM panel
           WHERE channel IN ({PAID_SQL}) GROUP BY channel),
b AS (SELECT a.channel, CASE WHEN spend > 0 THEN gmv / spend ELSE 0 END AS roas, p.roas_lo * (1 - 0.3) AS band_lo,
        p.roas_hi * (1 + 0.3) AS band_hi FROM a JOIN priors p ON p.channel = a.channel)
SELECT channel, {_r4('roas')}, {_r4('band_lo')}, {_r4('band_hi')}, roas >= band_lo AND roas <= band_hi AS in_band
FROM b""", "panel", "priors"))
def q_roas_bands(c: Chain) -> DataFrame:
    b = R.roas_bands(c.panel, c.priors)
    return b.select("channel", r4("roas"), r4("band_lo"), r4("band_hi"), "in_band")


@register("modelled_evc", O.sql(f"""
WITH a AS (SELECT p.date_local, p.market, p.channel, cast(coalesce(p.ads_attributed_orders, 0) AS double) AS orders,
             pr.evc_coverage AS cov FROM panel p LEFT JOIN priors pr ON pr.channel = p.channel
           WHERE p.channel IN ({PAID_SQL})),
b AS (SELECT *, CASE WHEN cov IS NULL THEN orders ELSE round_even(orders / greatest(1e-6, 1 - cov), 0) END AS all_c
      FROM a)
SELECT date_local, market, channel, {_r4('orders')}, {_r4('all_c', 'all_conversions')},
  {_r4('CASE WHEN cov IS NULL THEN 0 ELSE least(greatest(all_c * cov, 0), all_c) END', 'evc_conversions')}
FROM b""", "panel", "priors"))
def q_modelled_evc(c: Chain) -> DataFrame:
    m = R.modelled_evc(c.panel, c.priors)
    return m.select("date_local", "market", "channel", r4("orders"), r4("all_conversions"), r4("evc_conversions"))


@register("expected_funnel", O.sql(f"""
WITH a AS (SELECT p.date_local, p.market, p.channel, p.spend_usd,
             CASE WHEN pr.cpm > 0 THEN p.spend_usd / pr.cpm * 1000.0 ELSE 0 END AS impr, pr.ctr, pr.cvr
           FROM panel p JOIN priors pr ON pr.channel = p.channel WHERE p.channel IN ({PAID_SQL})),
b AS (SELECT *, least(impr * ctr, impr) AS clk FROM a)
SELECT date_local, market, channel, {_r4('spend_usd')}, {_r4('impr', 'exp_impressions')},
  {_r4('clk', 'exp_clicks')}, {_r4('least(clk * cvr, clk)', 'exp_orders')}
FROM b""", "panel", "priors"))
def q_expected_funnel(c: Chain) -> DataFrame:
    e = R.expected_funnel(c.panel, c.priors)
    return e.select("date_local", "market", "channel", r4("spend_usd"), r4("exp_impressions"), r4("exp_clicks"),
                    r4("exp_orders"))


@register("cross_rate", O.sql(f"""
SELECT f.date_local, f.market, f.platform, f.shop_id, f.sku_id, {_r4('f.gmv_net_local', 'gmv_net_local')},
  {_r4('cast(f.gmv_net_local AS double) * CASE WHEN dm.market IS NULL THEN 1.0 ELSE '
       'cast(t.usd_rate AS double) / cast(r.usd_rate AS double) END', 'gmv_net_local_sgd')}
FROM fact_platform_sales f
LEFT JOIN dim_market dm ON dm.market = f.market
LEFT JOIN fx r ON r.date = f.date_local AND r.currency = dm.currency
LEFT JOIN fx t ON t.date = f.date_local AND t.currency = 'SGD'""", "fact_platform_sales", "dim_market", "fx"))
def q_cross_rate(c: Chain) -> DataFrame:
    x = R.cross_rate(c.fact_platform_sales, "gmv_net_local", "market", "date_local", "SGD", c.dim_market, c.fx)
    return x.select("date_local", "market", "platform", "shop_id", "sku_id", r4("gmv_net_local"),
                    r4("gmv_net_local_sgd"))
