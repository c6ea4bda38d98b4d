"""Registered decomposition, pacing and reallocation queries with oracles."""

from __future__ import annotations

import calendar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT as P
from ..operators import decisions as D
from ..sources import seeds as S
from . import oracle as O
from .chain import Chain
from .registry import _r4, r4, register
from .registry_analytics import PAID_SQL, _kpi_sql

frag = O.frag
MONTH_LO = P.as_of.replace(day=1)
DOM = P.as_of.day
MD = calendar.monthrange(P.as_of.year, P.as_of.month)[1]

frag("blended", ["story"], f"""
SELECT sum(CASE WHEN wk = 'now' THEN gmv END) AS gmv_now, sum(CASE WHEN wk = 'prev' THEN gmv END) AS gmv_prev
FROM ({_kpi_sql('story', ['wk'])}) k
HAVING sum(CASE WHEN wk = 'now' THEN spend END) IS NOT NULL OR sum(CASE WHEN wk = 'prev' THEN spend END) IS NOT NULL
""")


@register("lever_bridge", O.sql(f"""
WITH d AS (SELECT date_local, CASE WHEN rn <= 7 THEN 'now' ELSE 'prev' END AS wk FROM (
    SELECT date_local, row_number() OVER (ORDER BY date_local DESC) AS rn FROM (SELECT DISTINCT date_local FROM scan) x)
    y WHERE rn <= 14),
g AS (
  SELECT channel,
    cast(sum(CASE WHEN wk = 'now' THEN impressions ELSE 0 END) AS double) AS impr_now,
    cast(sum(CASE WHEN wk = 'prev' THEN impressions ELSE 0 END) AS double) AS impr_prev,
    cast(sum(CASE WHEN wk = 'now' THEN clicks ELSE 0 END) AS double) AS clk_now,
    cast(sum(CASE WHEN wk = 'prev' THEN clicks ELSE 0 END) AS double) AS clk_prev,
    sum(CASE WHEN wk = 'now' THEN ads_orders ELSE 0 END) AS ord_now,
    sum(CASE WHEN wk = 'prev' THEN ads_orders ELSE 0 END) AS ord_prev,
    sum(CASE WHEN wk = 'now' THEN ads_gmv_usd ELSE 0 END) AS gmv_now,
    sum(CASE WHEN wk = 'prev' THEN ads_gmv_usd ELSE 0 END) AS gmv_prev
  FROM scan JOIN d USING (date_local) WHERE channel IN ({PAID_SQL}) GROUP BY channel),
v AS (
  SELECT channel, gmv_now - gmv_prev AS d_gmv, impr_now AS now_impressions, impr_prev AS prev_impressions,
    CASE WHEN impr_now > 0 THEN clk_now / impr_now ELSE 0 END AS now_ctr,
    CASE WHEN impr_prev > 0 THEN clk_prev / impr_prev ELSE 0 END AS prev_ctr,
    CASE WHEN clk_now > 0 THEN ord_now / clk_now ELSE 0 END AS now_cvr,
    CASE WHEN clk_prev > 0 THEN ord_prev / clk_prev ELSE 0 END AS prev_cvr,
    CASE WHEN ord_now > 0 THEN gmv_now / ord_now ELSE 0 END AS now_aov,
    CASE WHEN ord_prev > 0 THEN gmv_prev / ord_prev ELSE 0 END AS prev_aov
  FROM g),
l AS (
  SELECT channel, d_gmv, lever, lever_order, prev_value, now_value,
    CASE WHEN prev_value > 0 AND now_value > 0 THEN ln(now_value / prev_value) ELSE 0 END AS ln_value
  FROM v, LATERAL (VALUES ('impressions', 0, prev_impressions, now_impressions), ('ctr', 1, prev_ctr, now_ctr),
                          ('cvr', 2, prev_cvr, now_cvr), ('aov', 3, prev_aov, now_aov))
       AS t(lever, lever_order, prev_value, now_value))
SELECT channel, lever, lever_order, {_r4('prev_value')}, {_r4('now_value')},
  {_r4('d_gmv * CASE WHEN tot <> 0 THEN ln_value / tot ELSE 0 END', 'contribution')}
FROM (SELECT *, sum(ln_value) OVER (PARTITION BY channel) AS tot FROM l) z""", "scan"))
def q_lever_bridge(c: Chain) -> DataFrame:
    d = D.lever_bridge(c.scan, c.p)
    return d.select("channel", "lever", "lever_order", r4("prev_value"), r4("now_value"), r4("contribution"))


@register("waterfall", O.sql(f"""
WITH d AS (
  SELECT *, gmv_now - gmv_prev AS delta,
    (spend_now > {P.waterfall_min_spend} OR spend_prev > {P.waterfall_min_spend}) AS elig FROM deltas),
r AS (SELECT *, CASE WHEN elig THEN row_number() OVER (PARTITION BY elig ORDER BY abs(delta) DESC,
        spend_now DESC, tax_order) END AS rk FROM d),
items AS (
  SELECT 0 AS step, 'Prior wk' AS label, 'start' AS item, gmv_prev AS value FROM blended
  UNION ALL
  SELECT rk, label, 'channel', delta FROM r, blended WHERE elig AND rk <= {P.top_n_waterfall}
  UNION ALL
  SELECT {P.top_n_waterfall + 1}, 'Other', 'other',
    coalesce((SELECT sum(delta) FROM r WHERE NOT elig OR rk > {P.top_n_waterfall}), 0) FROM blended
  UNION ALL
  SELECT {P.top_n_waterfall + 2}, 'Unattributed', 'unattributed',
    gmv_now - gmv_prev - coalesce((SELECT sum(delta) FROM r WHERE elig AND rk <= {P.top_n_waterfall}), 0)
    - coalesce((SELECT sum(delta) FROM r WHERE NOT elig OR rk > {P.top_n_waterfall}), 0) FROM blended
  UNION ALL
  SELECT {P.top_n_waterfall + 3}, 'This wk', 'end', gmv_now FROM blended),
run AS (
  SELECT *, max(CASE WHEN item = 'start' THEN value END) OVER ()
    + sum(CASE WHEN item IN ('start', 'end') THEN 0 ELSE value END) OVER (ORDER BY step
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after_v,
    CASE WHEN item IN ('start', 'end') THEN 0 ELSE value END AS stepv
  FROM items)
SELECT cast(step AS int) AS step, label,
  CASE WHEN item IN ('start', 'end') THEN item WHEN value >= 0 THEN 'plus' ELSE 'minus' END AS kind,
  {_r4('value')},
  {_r4("CASE WHEN item IN ('start', 'end') THEN 0 WHEN value >= 0 THEN after_v - stepv ELSE after_v END", 'bottom')},
  {_r4("CASE WHEN item IN ('start', 'end') THEN value WHEN value >= 0 THEN after_v ELSE after_v - stepv END", 'top')}
FROM run""", "deltas", "blended"))
def q_waterfall(c: Chain) -> DataFrame:
    d = D.waterfall(c.deltas, c.blended, c.p)
    return d.select(F.col("step").cast("int").alias("step"), "label", "kind", r4("value"), r4("bottom"), r4("top"))


@register("mix_table", O.sql(f"""
SELECT channel, label, {_r4('spend_now', 'spend')}, {_r4('roas_now', 'roas')}, {_r4('gmv_now', 'gmv')},
  {_r4('CASE WHEN s > 0 THEN spend_now / s ELSE 0 END', 'spend_share')},
  {_r4('CASE WHEN s > 0 THEN sr / s ELSE 0 END', 'weighted_roas')}
FROM (SELECT *, sum(spend_now) OVER () AS s, sum(spend_now * roas_now) OVER () AS sr
      FROM deltas WHERE spend_now > {P.mix_min_spend}) x""", "deltas"))
def q_mix_table(c: Chain) -> DataFrame:
    d = D.mix_table(c.deltas, c.p)
    return d.select("channel", "label", r4("spend"), r4("roas"), r4("gmv"), r4("spend_share"), r4("weighted_roas"))


frag("month_rows", ["scan"], f"SELECT * FROM scan WHERE date_local BETWEEN DATE '{MONTH_LO}' AND DATE '{P.as_of}'")


def _pace_sql():
    m = P.plan_mult
    parts = []
    for name, actual, fc, mult in (("gmv", "gmv", f"gmv * {MD} / {DOM}", m["gmv"]),
                                   ("spend", "spend", f"spend * {MD} / {DOM}", m["spend"]),
                                   ("orders", "cast(orders AS double)", f"orders * {MD} / {DOM}", m["orders"]),
                                   ("roas", "roas", "roas", m["roas"])):
        parts.append(f"SELECT '{name}' AS metric, {actual} AS actual, {fc} AS forecast, ({fc}) * {mult} AS plan "
                     f"FROM k")
    return " UNION ALL ".join(parts)


@register("pacing", O.sql(f"""
WITH k AS ({_kpi_sql('month_rows', [])}),
u AS ({_pace_sql()})
SELECT metric, {_r4('actual')}, {_r4('plan')}, {_r4('forecast')}, {DOM} AS day_of_month, {MD - DOM} AS days_left,
  {_r4('CASE WHEN plan > 0 THEN forecast / plan ELSE 0 END', 'pace_ratio')},
  CASE WHEN (CASE WHEN plan > 0 THEN forecast / plan ELSE 0 END) < {S.PACING_BAND[0]} THEN 'behind'
       WHEN (CASE WHEN plan > 0 THEN forecast / plan ELSE 0 END) > {S.PACING_BAND[1]} THEN 'over' ELSE 'on' END
    AS status
FROM u""", "month_rows"))
def q_pacing(c: Chain) -> DataFrame:
    d = D.pacing(c.scan, c.p)
    return d.select("metric", r4("actual"), r4("plan"), r4("forecast"), "day_of_month", "days_left",
                    r4("pace_ratio"), "status")


@register("channel_pacing", O.sql(f"""
WITH a AS (
  SELECT t.channel, t.label, coalesce(s.actual, 0) AS actual, coalesce(s.actual, 0) * {MD} / {DOM} AS forecast
  FROM taxonomy t LEFT JOIN (SELECT channel, sum(spend_usd) AS actual FROM month_rows GROUP BY 1) s
    ON s.channel = t.channel
  WHERE t.grp <> 'organic'),
b AS (SELECT *, forecast * ({S.CHANNEL_PLAN_BASE} + (length(channel) % {S.CHANNEL_PLAN_MOD}) * {S.CHANNEL_PLAN_STEP})
      AS plan FROM a)
SELECT channel, label, {_r4('actual')}, {_r4('plan')}, {_r4('forecast')},
  {_r4('forecast / greatest(plan, 1)', 'pace_ratio')},
  CASE WHEN forecast / greatest(plan, 1) < {S.PACING_BAND[0]} THEN 'behind'
       WHEN forecast / greatest(plan, 1) > {S.PACING_BAND[1]} THEN 'over' ELSE 'on' END AS status
FROM b""", "month_rows", "taxonomy"))
def q_channel_pacing(c: Chain) -> DataFrame:
    d = D.channel_pacing(c.scan, c.taxonomy, c.p)
    return d.select("channel", "label", r4("actual"), r4("plan"), r4("forecast"), r4("pace_ratio"), "status")


GT, GC, GS = S.REALLOC_GOOGLE
ST, SC, SS = S.REALLOC_SHOPEE_ADS
K, SH = S.REALLOC_TRIM_IMPACT, S.REALLOC_SHIFT_SHARE
SHOPEE_ORDER_SQL = "list_position(['" + "', '".join(D.SHOPEE_AD_ORDER) + "'], channel)"


@register("reallocation", O.sql(f"""
WITH g AS (SELECT *, roas_shift_pct < {GT} AS trim,
             floor(spend_now * CASE WHEN roas_shift_pct < {GT} THEN {GC} ELSE {GS} END + 0.5) AS dol
           FROM deltas WHERE channel = 'google_ads_shopee'),
sh0 AS (SELECT *, row_number() OVER (ORDER BY spend_now DESC, {SHOPEE_ORDER_SQL}) AS r FROM deltas
        WHERE channel IN ('{"', '".join(D.SHOPEE_AD_ORDER)}')),
sh AS (SELECT *, roas_shift_pct < {ST} AS trim,
         floor(spend_now * CASE WHEN roas_shift_pct < {ST} THEN {SC} ELSE {SS} END + 0.5) AS dol
       FROM sh0 WHERE r = 1),
cand AS (SELECT * FROM deltas WHERE channel NOT IN ('google_ads_shopee', 'meta_cpas')
           AND channel NOT IN (SELECT channel FROM sh)
           AND spend_now > {P.partner_min_spend} AND roas_prev > 0),
partner AS (SELECT * FROM cand ORDER BY roas_now DESC, spend_now DESC, tax_order LIMIT 1),
meta AS (SELECT spend_now AS m_spend, roas_now AS m_roas FROM deltas WHERE channel = 'meta_cpas'),
u AS (
  SELECT 1 AS rule, CASE WHEN trim THEN 'cut' ELSE 'scale' END AS action,
    CASE WHEN trim THEN channel END AS from_channel, CASE WHEN NOT trim THEN channel END AS to_channel,
    dol AS dollars, CASE WHEN trim THEN -floor(dol * (roas_now * {K}) + 0.5) ELSE floor(dol * roas_now + 0.5) END
      AS impact, 'high' AS conviction FROM g
  UNION ALL
  SELECT 2, CASE WHEN trim THEN 'cut' ELSE 'scale' END, CASE WHEN trim THEN channel END,
    CASE WHEN NOT trim THEN channel END, dol,
    CASE WHEN trim THEN -floor(dol * (roas_now * {K}) + 0.5) ELSE floor(dol * roas_now + 0.5) END, 'medium' FROM sh
  UNION ALL
  SELECT 3, 'shift', 'meta_cpas', p.channel, floor(least(m_spend, p.spend_now) * {SH} + 0.5),
    greatest(floor(floor(least(m_spend, p.spend_now) * {SH} + 0.5) * (p.roas_now - m_roas) + 0.5), 0), 'medium'
  FROM partner p, meta)
SELECT cast(rule AS int) AS rule, action, from_channel, to_channel, {_r4('dollars')}, {_r4('impact')}, conviction
FROM u""", "deltas"))
def q_reallocation(c: Chain) -> DataFrame:
    d = D.reallocation(c.deltas, c.p)
    return d.select(F.col("rule").cast("int").alias("rule"), "action", "from_channel", "to_channel",
                    r4("dollars"), r4("impact"), "conviction")
