"""Registered analytics queries on the panel (daily report, weekly story,
brief, metadata), each with its DuckDB oracle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT as P
from ..operators import metrics as M
from ..sources import seeds as S
from ..sources.seeds import MARKET_CODES, PAID_CHANNELS
from . import oracle as O
from .chain import Chain
from .registry import _r4, r4, register

frag = O.frag
SCAN_LO = P.as_of - dt.timedelta(days=M.scan_reach(P))
RANGE_LO = P.as_of - dt.timedelta(days=P.range_days - 1)
PAID_SQL = ", ".join(f"'{c}'" for c in PAID_CHANNELS)
MK_ORDER = "list_position(['" + "', '".join(MARKET_CODES) + "'], market)"


def PAID_DIM(rows: str) -> str:
    """Paid channels of the taxonomy, and channels of ``rows`` it lacks."""
    return (f"SELECT channel, priority FROM taxonomy WHERE grp <> 'organic' UNION ALL SELECT DISTINCT channel, 99 "
            f"FROM {rows} WHERE channel NOT IN (SELECT channel FROM taxonomy)")


def _kpi_sql(src: str, by: list[str]) -> str:
    b = "".join(f"{x}, " for x in by)
    g = ", ".join(by)
    return f"""
SELECT {b}sum(spend) AS spend, sum(gmv) AS gmv, cast(sum(orders) AS bigint) AS orders,
  sum(ads_gmv) AS ads_gmv, CASE WHEN sum(spend) > 0 THEN sum(ads_gmv) / sum(spend) ELSE 0 END AS roas
FROM (
  SELECT {b}date_local, market, platform, sum(spend_usd) AS spend, sum(ads_gmv_usd) AS ads_gmv,
    max(coalesce(platform_total_gmv_usd, 0)) AS gmv, max(coalesce(platform_total_orders, 0)) AS orders
  FROM {src} GROUP BY {b}date_local, market, platform
) l1 {'GROUP BY ' + g if by else ''}"""


frag("scan", ["panel", "taxonomy"], f"""
SELECT p.date_local, p.market, p.channel, coalesce(t.label, p.channel) AS label,
  coalesce(p.platform, t.platform, 'shopee') AS platform, coalesce(t.grp, 'on_platform') AS grp,
  coalesce(t.priority, 99) AS priority, coalesce(t.tax_order, 99) AS tax_order, p.spend_usd,
  coalesce(p.impressions, 0) AS impressions, coalesce(p.clicks, 0) AS clicks,
  cast(coalesce(p.ads_attributed_orders, 0) AS double) AS ads_orders,
  coalesce(p.ads_attributed_gmv_usd, 0) AS ads_gmv_usd, p.direct_gmv_usd, p.broad_gmv_usd,
  p.platform_total_gmv_usd, p.platform_total_orders, p.is_weekend, p.is_payday,
  coalesce(p.is_mega_sale, false) AS is_mega_sale
FROM panel p LEFT JOIN taxonomy t ON t.channel = p.channel
WHERE p.date_local BETWEEN DATE '{SCAN_LO}' AND DATE '{P.as_of}'
""")
frag("filtered", ["scan"], f"SELECT * FROM scan WHERE date_local >= DATE '{RANGE_LO}'")
frag("wk_dates", ["scan"], """
SELECT date_local, CASE WHEN rn <= 7 THEN 'now' ELSE 'prev' END AS wk
FROM (SELECT date_local, row_number() OVER (ORDER BY date_local DESC) AS rn, count(*) OVER () AS n
      FROM (SELECT DISTINCT date_local FROM scan) d) x
WHERE rn <= 14 AND n >= 14
""")
frag("story", ["scan", "wk_dates"], "SELECT s.*, w.wk FROM scan s JOIN wk_dates w USING (date_local)")
frag("deltas0", ["story", "taxonomy"], """
SELECT t.channel, t.label, t.grp, t.platform, t.priority, t.tax_order,
  coalesce(a.spend_now, 0) AS spend_now, coalesce(a.spend_prev, 0) AS spend_prev,
  coalesce(a.gmv_now, 0) AS gmv_now, coalesce(a.gmv_prev, 0) AS gmv_prev
FROM taxonomy t
JOIN (SELECT 1 AS k WHERE EXISTS (SELECT 1 FROM story)) s ON TRUE
LEFT JOIN (
  SELECT channel,
    sum(CASE WHEN wk = 'now' THEN spend_usd END) AS spend_now,
    sum(CASE WHEN wk = 'prev' THEN spend_usd END) AS spend_prev,
    sum(CASE WHEN wk = 'now' THEN ads_gmv_usd END) AS gmv_now,
    sum(CASE WHEN wk = 'prev' THEN ads_gmv_usd END) AS gmv_prev
  FROM story GROUP BY channel
) a ON a.channel = t.channel
WHERE t.grp <> 'organic'
""")
frag("deltas1", ["deltas0"], """
SELECT *, CASE WHEN spend_prev <> 0 THEN (spend_now - spend_prev) / spend_prev END AS spend_delta,
  CASE WHEN spend_now > 0 THEN gmv_now / spend_now ELSE 0 END AS roas_now,
  CASE WHEN spend_prev > 0 THEN gmv_prev / spend_prev ELSE 0 END AS roas_prev
FROM deltas0
""")
frag("deltas", ["deltas1"], """
SELECT *, roas_now - roas_prev AS roas_shift,
  CASE WHEN roas_prev > 0 THEN (roas_now - roas_prev) / roas_prev ELSE 0 END AS roas_shift_pct
FROM deltas1
""")
frag("levels", ["deltas"], f"""
SELECT *, CASE
  WHEN abs(coalesce(roas_shift_pct, 0)) > {S.ANOMALY_ROAS_SWING} AND spend_now > {P.anomaly_spend_floor}
    THEN 'data_issue'
  WHEN coalesce(spend_delta, 0) < {S.ANOMALY_SPEND_SLUMP} THEN 'slump'
  WHEN coalesce(roas_shift_pct, 0) < {S.ANOMALY_ROAS_SLUMP} THEN 'slump'
  WHEN coalesce(spend_delta, 0) > {S.ANOMALY_SPEND_SPIKE} THEN 'spike' ELSE 'healthy' END AS level
FROM deltas
""")
frag("mkt_kpi", ["story"], _kpi_sql("story", ["wk", "market"]))
frag("mkt_deltas", ["mkt_kpi", "dim_market", "story"], """
SELECT d.market, d.country_name,
  coalesce(sum(CASE WHEN wk = 'now' THEN gmv END), 0) AS gmv_now,
  coalesce(sum(CASE WHEN wk = 'prev' THEN gmv END), 0) AS gmv_prev,
  coalesce(sum(CASE WHEN wk = 'now' THEN spend END), 0) AS spend_now,
  coalesce(sum(CASE WHEN wk = 'prev' THEN spend END), 0) AS spend_prev,
  coalesce(sum(CASE WHEN wk = 'now' THEN roas END), 0) AS roas_now,
  coalesce(sum(CASE WHEN wk = 'prev' THEN roas END), 0) AS roas_prev
FROM dim_market d JOIN (SELECT 1 AS k WHERE EXISTS (SELECT 1 FROM story)) s ON TRUE
LEFT JOIN mkt_kpi k ON k.market = d.market
GROUP BY d.market, d.country_name
""")


def _pd(now, prev, alias):
    return f"CASE WHEN {prev} <> 0 THEN ({now} - {prev}) / {prev} END AS {alias}"


# ------------------------------------------------------------------ KPIs
@register("panel_meta", O.sql("""
SELECT min(date_local) AS min_date, max(date_local) AS max_date, count(*) AS row_count,
  array_to_string(list_sort(list_distinct(list(market))), ',') AS markets,
  array_to_string(list_sort(list_distinct(list(channel))), ',') AS channels
FROM panel""", "panel"))
def q_panel_meta(c: Chain) -> DataFrame:
    return c.published.meta("panel")


@register("kpi_blended", O.sql(f"""
SELECT {_r4('spend')}, {_r4('gmv')}, orders, {_r4('ads_gmv')}, {_r4('roas')}
FROM ({_kpi_sql('filtered', [])}) k""", "filtered"))
def q_kpi_blended(c: Chain) -> DataFrame:
    k = M.kpis(c.filtered)
    return k.select(r4("spend"), r4("gmv"), "orders", r4("ads_gmv"), r4("roas"))


@register("kpi_by_market", O.sql(f"""
SELECT d.market, d.country_name, {_r4('coalesce(k.spend, 0)', 'spend')}, {_r4('coalesce(k.gmv, 0)', 'gmv')},
  cast(coalesce(k.orders, 0) AS bigint) AS orders, {_r4('coalesce(k.ads_gmv, 0)', 'ads_gmv')},
  {_r4('coalesce(k.roas, 0)', 'roas')}
FROM dim_market d LEFT JOIN ({_kpi_sql('filtered', ['market'])}) k ON k.market = d.market""",
                                  "filtered", "dim_market"))
def q_kpi_by_market(c: Chain) -> DataFrame:
    k = M.kpi_by_market(c.filtered, c.dim_market)
    return k.select("market", "country_name", r4("spend"), r4("gmv"), F.col("orders").cast("long").alias("orders"),
                    r4("ads_gmv"), r4("roas"))


@register("market_trend", O.sql(f"""
SELECT d.date_local, m.market, {_r4('coalesce(k.gmv, 0)', 'gmv')}
FROM (SELECT date_local FROM (SELECT DISTINCT date_local FROM filtered) x
      ORDER BY date_local DESC LIMIT {P.trend_days}) d
CROSS JOIN dim_market m
LEFT JOIN ({_kpi_sql('filtered', ['date_local', 'market'])}) k ON k.date_local = d.date_local
  AND k.market = m.market""", "filtered", "dim_market"))
def q_market_trend(c: Chain) -> DataFrame:
    return M.market_trend(c.filtered, c.dim_market, c.p).select("date_local", "market", r4("gmv"))


@register("daily_series", O.sql(f"""
SELECT date_local, {_r4('spend')}, {_r4('gmv')} FROM ({_kpi_sql('filtered', ['date_local'])}) k""",
                                 "filtered"))
def q_daily_series(c: Chain) -> DataFrame:
    return M.daily_series(c.filtered).select("date_local", r4("spend"), r4("gmv"))


@register("channel_rollup", O.sql(f"""
SELECT t.channel, t.label, t.grp AS "group", t.priority, {_r4('coalesce(a.spend, 0)', 'spend')},
  {_r4('coalesce(a.gmv, 0)', 'gmv')},
  {_r4('CASE WHEN tot.s > 0 THEN coalesce(a.spend, 0) / tot.s ELSE 0 END', 'spend_share')},
  {_r4('CASE WHEN coalesce(a.spend, 0) > 0 THEN coalesce(a.gmv, 0) / a.spend ELSE 0 END', 'roas')}
FROM taxonomy t
LEFT JOIN (SELECT channel, sum(spend_usd) AS spend, sum(ads_gmv_usd) AS gmv FROM filtered GROUP BY 1) a
  ON a.channel = t.channel
CROSS JOIN (SELECT sum(spend_usd) AS s FROM filtered) tot""", "filtered", "taxonomy"))
def q_channel_rollup(c: Chain) -> DataFrame:
    d = M.channel_rollup(c.filtered, c.taxonomy)
    return d.select("channel", "label", "group", "priority", r4("spend"), r4("gmv"), r4("spend_share"), r4("roas"))


# ------------------------------------------------------------------ weekly story
@register("weekly_blended", O.sql(f"""
SELECT {_r4('spend_now')}, {_r4('spend_prev')}, {_r4('gmv_now')}, {_r4('gmv_prev')},
  cast(orders_now AS bigint) AS orders_now, cast(orders_prev AS bigint) AS orders_prev,
  {_r4('ads_gmv_now')}, {_r4('ads_gmv_prev')}, {_r4('roas_now')}, {_r4('roas_prev')},
  {_r4('spend_delta')}, {_r4('gmv_delta')}, {_r4('roas_delta')}, {_r4('orders_delta')}
FROM (
  SELECT *, {_pd('spend_now', 'spend_prev', 'spend_delta')}, {_pd('gmv_now', 'gmv_prev', 'gmv_delta')},
    {_pd('roas_now', 'roas_prev', 'roas_delta')}, {_pd('orders_now', 'orders_prev', 'orders_delta')}
  FROM (
    SELECT sum(CASE WHEN wk = 'now' THEN spend END) AS spend_now, sum(CASE WHEN wk = 'prev' THEN spend END) AS spend_prev,
      sum(CASE WHEN wk = 'now' THEN gmv END) AS gmv_now, sum(CASE WHEN wk = 'prev' THEN gmv END) AS gmv_prev,
      sum(CASE WHEN wk = 'now' THEN orders END) AS orders_now, sum(CASE WHEN wk = 'prev' THEN orders END) AS orders_prev,
      sum(CASE WHEN wk = 'now' THEN ads_gmv END) AS ads_gmv_now, sum(CASE WHEN wk = 'prev' THEN ads_gmv END) AS ads_gmv_prev,
      sum(CASE WHEN wk = 'now' THEN roas END) AS roas_now, sum(CASE WHEN wk = 'prev' THEN roas END) AS roas_prev
    FROM ({_kpi_sql('story', ['wk'])}) k
  ) x WHERE spend_now IS NOT NULL OR spend_prev IS NOT NULL
) y""", "story"))
def q_weekly_blended(c: Chain) -> DataFrame:
    k = M.weekly_blended(c.scan, c.p)
    return k.select(r4("spend_now"), r4("spend_prev"), r4("gmv_now"), r4("gmv_prev"),
                    F.col("orders_now").cast("long").alias("orders_now"),
                    F.col("orders_prev").cast("long").alias("orders_prev"),
                    r4("ads_gmv_now"), r4("ads_gmv_prev"), r4("roas_now"), r4("roas_prev"),
                    r4("spend_delta"), r4("gmv_delta"), r4("roas_delta"), r4("orders_delta"))


DELTA_COLS = ["spend_now", "spend_prev", "spend_delta", "gmv_now", "gmv_prev", "roas_now", "roas_prev",
              "roas_shift", "roas_shift_pct"]


@register("channel_deltas", O.sql(
    "SELECT channel, label, grp AS \"group\", platform, " + ", ".join(_r4(x) for x in DELTA_COLS)
    + " FROM deltas", "deltas"))
def q_channel_deltas(c: Chain) -> DataFrame:
    return c.deltas.select("channel", "label", "group", "platform", *[r4(x) for x in DELTA_COLS])


@register("market_deltas", O.sql(f"""
SELECT market, country_name, {_r4('gmv_now')}, {_r4('spend_now')}, {_r4('roas_now')},
  {_r4(f"CASE WHEN gmv_prev <> 0 THEN (gmv_now - gmv_prev) / gmv_prev END", 'gmv_delta')},
  {_r4(f"CASE WHEN spend_prev <> 0 THEN (spend_now - spend_prev) / spend_prev END", 'spend_delta')},
  {_r4(f"CASE WHEN roas_prev <> 0 THEN (roas_now - roas_prev) / roas_prev END", 'roas_delta')}
FROM mkt_deltas""", "mkt_deltas"))
def q_market_deltas(c: Chain) -> DataFrame:
    return c.mkt_deltas.select("market", "country_name", r4("gmv_now"), r4("spend_now"), r4("roas_now"),
                               r4("gmv_delta"), r4("spend_delta"), r4("roas_delta"))


@register("top_movers", O.sql(f"""
SELECT kind, id, {_r4('value')} FROM (
  SELECT 'top_mover' AS kind, channel AS id, spend_delta AS value FROM (
    SELECT *, row_number() OVER (ORDER BY abs(spend_delta) DESC, tax_order) AS r FROM deltas
    WHERE spend_now > {P.material_spend} AND spend_prev > {P.material_spend} AND spend_delta IS NOT NULL) a
  WHERE r = 1
  UNION ALL
  SELECT 'top_roas_shift', channel, roas_shift FROM (
    SELECT *, row_number() OVER (ORDER BY abs(roas_shift) DESC, tax_order) AS r FROM deltas
    WHERE spend_now > {P.material_spend} AND spend_prev > {P.material_spend} AND spend_delta IS NOT NULL) b
  WHERE r = 1
  UNION ALL
  SELECT 'lead_market', market, gmv_now FROM (
    SELECT *, row_number() OVER (ORDER BY gmv_now DESC, {MK_ORDER}) AS r FROM mkt_deltas) m
  WHERE r = 1
) u""", "deltas", "mkt_deltas"))
def q_top_movers(c: Chain) -> DataFrame:
    return M.top_movers(c.deltas, c.mkt_deltas, c.p).select("kind", "id", r4("value"))


@register("anomaly_levels", O.sql(f"""
SELECT channel, level, {_r4('spend_delta')}, {_r4('roas_shift_pct')}, {_r4('spend_now')} FROM levels""",
                                  "levels"))
def q_anomaly_levels(c: Chain) -> DataFrame:
    return c.levels.select("channel", "level", r4("spend_delta"), r4("roas_shift_pct"), r4("spend_now"))


@register("watchlist", O.sql(f"""
SELECT cast(row_number() OVER (ORDER BY r) AS int) AS rank, channel, {_r4('spend_now')}, {_r4('spend_delta')}
FROM (SELECT *, row_number() OVER (ORDER BY spend_now DESC, tax_order) AS r FROM deltas) d
WHERE spend_now > {P.watchlist_min_spend} AND spend_delta IS NOT NULL
QUALIFY row_number() OVER (ORDER BY r) <= {P.watchlist_size}""", "deltas"))
def q_watchlist(c: Chain) -> DataFrame:
    return M.watchlist(c.deltas, c.p).select("rank", "channel", r4("spend_now"), r4("spend_delta"))


# ------------------------------------------------------------------ daily report
@register("share_divergence", O.sql(f"""
SELECT channel, priority, {_r4('spend_share')}, {_r4('gmv_share')}, {_r4('spend_share - gmv_share', 'share_diff')},
  abs(spend_share - gmv_share) > {P.divergence} AS is_divergent
FROM (
  SELECT t.channel, t.priority,
    CASE WHEN tot.s > 0 THEN coalesce(a.spend, 0) / tot.s ELSE 0 END AS spend_share,
    CASE WHEN tot.g > 0 THEN coalesce(a.gmv, 0) / tot.g ELSE 0 END AS gmv_share
  FROM taxonomy t
  LEFT JOIN (SELECT channel, sum(spend_usd) AS spend, sum(ads_gmv_usd) AS gmv FROM filtered GROUP BY 1) a
    ON a.channel = t.channel
  CROSS JOIN (SELECT sum(spend_usd) AS s, sum(ads_gmv_usd) AS g FROM filtered) tot
  WHERE t.grp <> 'organic'
) x WHERE spend_share > {P.share_floor} OR gmv_share > {P.share_floor}""", "filtered", "taxonomy"))
def q_share_divergence(c: Chain) -> DataFrame:
    d = M.share_divergence(c.filtered, c.taxonomy, c.p)
    return d.select("channel", "priority", r4("spend_share"), r4("gmv_share"), r4("share_diff"), "is_divergent")


@register("attribution_roas", O.sql(f"""
SELECT t.channel, t.platform, t.priority, {_r4('coalesce(a.spend, 0)', 'spend')},
  {_r4('CASE WHEN coalesce(a.spend, 0) > 0 THEN coalesce(a.direct, 0) / a.spend ELSE 0 END', 'direct_roas')},
  {_r4('CASE WHEN coalesce(a.spend, 0) > 0 THEN coalesce(a.broad, 0) / a.spend ELSE 0 END', 'broad_roas')},
  {_r4('CASE WHEN coalesce(a.spend, 0) > 0 THEN coalesce(a.ads, 0) / a.spend ELSE 0 END', 'ads_roas')},
  coalesce(l.level, 'healthy') AS level
FROM taxonomy t
LEFT JOIN (SELECT channel, sum(spend_usd) AS spend, sum(coalesce(direct_gmv_usd, 0)) AS direct,
             sum(coalesce(broad_gmv_usd, 0)) AS broad, sum(ads_gmv_usd) AS ads FROM filtered GROUP BY 1) a
  ON a.channel = t.channel
LEFT JOIN levels l ON l.channel = t.channel
WHERE t.grp <> 'organic'""", "filtered", "taxonomy", "levels"))
def q_attribution_roas(c: Chain) -> DataFrame:
    d = M.attribution_roas(c.filtered, c.taxonomy, c.levels)
    return d.select("channel", "platform", "priority", r4("spend"), r4("direct_roas"), r4("broad_roas"),
                    r4("ads_roas"), "level")


@register("promo_days", O.sql("""
SELECT date_local, market, bool_or(is_payday) AS is_payday, bool_or(is_mega_sale) AS is_mega_sale,
  CASE WHEN bool_or(is_mega_sale) THEN cast(month(date_local) AS varchar) || '.' || cast(day(date_local) AS varchar)
  END AS mega_label
FROM filtered GROUP BY date_local, market""", "filtered"))
def q_promo_days(c: Chain) -> DataFrame:
    return M.promo_days(c.filtered)


@register("top_channel_stack", O.sql(f"""
SELECT ch.channel, d.date_local, {_r4('coalesce(s.spend, 0)', 'spend')}, ch.rank
FROM (SELECT channel, cast(row_number() OVER (ORDER BY total DESC, priority, channel) AS int) AS rank
      FROM (SELECT t.channel, t.priority, coalesce(a.total, 0) AS total FROM ({PAID_DIM('filtered')}) t
            LEFT JOIN (SELECT channel, sum(spend_usd) AS total FROM filtered GROUP BY 1) a
            ON a.channel = t.channel) x
      QUALIFY rank <= {P.top_n_stack}) ch
CROSS JOIN (SELECT DISTINCT date_local FROM filtered) d
LEFT JOIN (SELECT date_local, channel, sum(spend_usd) AS spend FROM filtered GROUP BY 1, 2) s
  ON s.date_local = d.date_local AND s.channel = ch.channel""", "filtered", "taxonomy"))
def q_top_channel_stack(c: Chain) -> DataFrame:
    d = M.top_channel_stack(c.filtered, c.taxonomy, c.p)
    return d.select("channel", "date_local", r4("spend"), F.col("rank").cast("int").alias("rank"))


# ------------------------------------------------------------------ channel brief
@register("channel_trend", O.sql(f"""
SELECT d.date_local, {_r4('coalesce(s.spend, 0)', 'spend')},
  {_r4('CASE WHEN coalesce(s.spend, 0) > 0 THEN s.gmv / s.spend ELSE 0 END', 'roas')}
FROM (SELECT DISTINCT date_local FROM scan ORDER BY date_local DESC LIMIT {P.trend_days}) d
LEFT JOIN (SELECT date_local, sum(spend_usd) AS spend, sum(ads_gmv_usd) AS gmv FROM scan
           WHERE channel = '{P.focus_channel}' GROUP BY 1) s ON s.date_local = d.date_local""", "scan"))
def q_channel_trend(c: Chain) -> DataFrame:
    return M.channel_trend(c.scan, c.p).select("date_local", r4("spend"), r4("roas"))


@register("heatmap", O.sql(f"""
SELECT market, date_local, {_r4('value')}, {_r4('greatest(max(value) OVER (), 0)', 'max_value')} FROM (
  SELECT m.market, d.date_local, coalesce(s.spend, 0) AS value
  FROM (SELECT DISTINCT date_local FROM scan ORDER BY date_local DESC LIMIT {P.heatmap_days}) d
  CROSS JOIN dim_market m
  LEFT JOIN (SELECT date_local, market, sum(spend_usd) AS spend FROM scan
             WHERE channel = '{P.focus_channel}' GROUP BY 1, 2) s
    ON s.date_local = d.date_local AND s.market = m.market) x""", "scan", "dim_market"))
def q_heatmap(c: Chain) -> DataFrame:
    return M.heatmap(c.scan, c.dim_market, c.p).select("market", "date_local", r4("value"), r4("max_value"))


@register("channel_market_grid", O.sql(f"""
SELECT channel, market, date_local, {_r4('spend')}, {_r4('now_total')}, {_r4('prev_total')},
  {_r4('CASE WHEN prev_total > 0 THEN (now_total - prev_total) / prev_total END', 'delta')}
FROM (
  SELECT ch.channel, m.market, d.date_local, d.wk, coalesce(s.spend, 0) AS spend,
    sum(CASE WHEN d.wk = 'now' THEN coalesce(s.spend, 0) ELSE 0 END) OVER (PARTITION BY ch.channel, m.market) AS now_total,
    sum(CASE WHEN d.wk = 'prev' THEN coalesce(s.spend, 0) ELSE 0 END) OVER (PARTITION BY ch.channel, m.market) AS prev_total
  FROM (SELECT date_local, CASE WHEN rn <= 14 THEN 'now' ELSE 'prev' END AS wk FROM (
          SELECT date_local, row_number() OVER (ORDER BY date_local DESC) AS rn
          FROM (SELECT DISTINCT date_local FROM scan) x) y WHERE rn <= 28) d
  CROSS JOIN (SELECT channel FROM ({PAID_DIM('scan')}) t) ch
  CROSS JOIN dim_market m
  LEFT JOIN (SELECT date_local, channel, market, sum(spend_usd) AS spend FROM scan GROUP BY 1, 2, 3) s
    ON s.date_local = d.date_local AND s.channel = ch.channel AND s.market = m.market
) z WHERE wk = 'now'""", "scan", "taxonomy", "dim_market"))
def q_channel_market_grid(c: Chain) -> DataFrame:
    d = M.channel_market_grid(c.scan, c.taxonomy, c.dim_market, c.p)
    return d.select("channel", "market", "date_local", r4("spend"), r4("now_total"), r4("prev_total"), r4("delta"))


PREV_LO = P.as_of - dt.timedelta(days=2 * P.range_days - 1)
PREV_HI = P.as_of - dt.timedelta(days=P.range_days)


@register("period_compare", O.sql(f"""
SELECT channel, period, {_r4('spend')}, {_r4('ads_gmv')}, cast(impressions AS bigint) AS impressions,
  cast(clicks AS bigint) AS clicks, {_r4('orders')},
  {_r4('CASE WHEN spend > 0 THEN ads_gmv / spend ELSE 0 END', 'roas')},
  {_r4('CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0 END', 'ctr')},
  {_r4('CASE WHEN clicks > 0 THEN orders / clicks ELSE 0 END', 'cvr')}
FROM (
  SELECT channel, CASE WHEN date_local >= DATE '{RANGE_LO}' THEN 'now' ELSE 'prev' END AS period,
    sum(spend_usd) AS spend, sum(ads_gmv_usd) AS ads_gmv, sum(impressions) AS impressions,
    sum(clicks) AS clicks, sum(ads_orders) AS orders
  FROM scan WHERE grp <> 'organic'
    AND (date_local >= DATE '{RANGE_LO}' OR date_local BETWEEN DATE '{PREV_LO}' AND DATE '{PREV_HI}')
  GROUP BY 1, 2
) x""", "scan"))
def q_period_compare(c: Chain) -> DataFrame:
    d = M.period_compare(c.scan, c.p)
    return d.select("channel", "period", r4("spend"), r4("ads_gmv"), F.col("impressions").cast("long").alias("impressions"),
                    F.col("clicks").cast("long").alias("clicks"), r4("orders"), r4("roas"), r4("ctr"), r4("cvr"))
