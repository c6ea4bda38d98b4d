"""Registered maintenance, quality, feature and IO queries with oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT as P
from ..operators import conform, facts, features, lift, quality, upsert
from ..sources import io, schemas, seeds
from . import oracle as O
from .chain import Chain
from .registry import _r4, r4, register

frag = O.frag
FIRST_LOAD_CUTOFF = dt.datetime(2024, 1, 20)
REFRESH_DAYS = 21
REFRESH_LO = P.as_of - dt.timedelta(days=REFRESH_DAYS)
FINAL_LO = P.as_of - dt.timedelta(days=P.final_lag_days - 1)

# ------------------------------------------------------------------ upsert
frag("raw_tiktok_ads_first", ["raw_tiktok_ads"],
     f"SELECT * FROM raw_tiktok_ads WHERE ingested_at < TIMESTAMP '{FIRST_LOAD_CUTOFF}' OR \"Date\" < DATE '{REFRESH_LO}'")
frag("raw_shopee_ads_first", ["raw_shopee_ads"],
     f"SELECT * FROM raw_shopee_ads WHERE ingested_at < TIMESTAMP '{FIRST_LOAD_CUTOFF}' OR \"Date\" < DATE '{REFRESH_LO}'")
frag("stg_on_first", ["raw_tiktok_ads_first", "raw_shopee_ads_first", "fx"],
     O.F["stg_onplatform_ads"][1].replace("FROM raw_tiktok_ads", "FROM raw_tiktok_ads_first")
     .replace("FROM raw_shopee_ads", "FROM raw_shopee_ads_first"))
frag("fact_on_first", ["stg_on_first"],
     O.F["fact_onplatform_ads"][1].replace("FROM stg_onplatform_ads", "FROM stg_on_first"))
ON_KEY = facts.ONPLATFORM_KEY
ON_OUT = ["date_local", "market", "platform", "ad_type", "objective", "campaign_id", "ad_group_id", "sku_id",
          "spend_usd", "impressions", "clicks", "direct_orders", "broad_orders", "direct_gmv_usd", "broad_gmv_usd"]
ON_MONEY = {"spend_usd", "direct_gmv_usd", "broad_gmv_usd"}


@register("upsert_fact", O.sql(f"""
WITH src AS (SELECT * FROM fact_onplatform_ads WHERE date_local >= DATE '{REFRESH_LO}'),
merged AS (
  SELECT * FROM src
  UNION ALL
  SELECT t.* FROM fact_on_first t WHERE NOT EXISTS (
    SELECT 1 FROM src s WHERE {' AND '.join(f's.{k} IS NOT DISTINCT FROM t.{k}' for k in ON_KEY)}))
SELECT {', '.join(_r4(x) if x in ON_MONEY else x for x in ON_OUT)} FROM merged""",
                                "fact_onplatform_ads", "fact_on_first"))
def q_upsert_fact(c: Chain) -> DataFrame:
    # The first load held all days before the window, and the window's rows
    # that had come by then: with the second load no row is in neither.
    first = (F.col("ingested_at") < F.lit(FIRST_LOAD_CUTOFF).cast("timestamp")) | (F.col("Date") < F.lit(REFRESH_LO))
    stg1 = conform.stg_onplatform_ads(c.raw["tiktok_ads_daily"].where(first),
                                      c.raw["shopee_ads_daily"].where(first), c.fx)
    target = facts.fact_onplatform_ads(stg1, c.p.as_of)
    source = facts.fact_onplatform_ads(c.stg_onplatform_ads, c.p.as_of, refresh_days=REFRESH_DAYS)
    m = upsert.upsert(target, source, ON_KEY)
    return m.select(*[r4(x) if x in ON_MONEY else x for x in ON_OUT])


@register("final_days", O.sql(f"""
SELECT date_local, count(*) AS fact_rows, {_r4('sum(gmv_net_usd)', 'gmv_net_usd')},
  date_local < DATE '{FINAL_LO}' AS is_final
FROM fact_platform_sales GROUP BY date_local""", "fact_platform_sales"))
def q_final_days(c: Chain) -> DataFrame:
    g = c.fact_platform_sales.groupBy("date_local").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("gmv_net_usd").alias("gmv_net_usd"))
    return upsert.final_flag(g, c.p.as_of, c.p.final_lag_days).select(
        "date_local", "fact_rows", r4("gmv_net_usd"), "is_final")


# ------------------------------------------------------------------ seeds on data days
@register("fx_spine", O.sql(f"""
WITH src AS (SELECT d.date_local AS date, r.currency, cast(r.usd_rate AS decimal(12,6)) AS usd_rate
             FROM (SELECT DISTINCT date_local FROM stg_platform_sales WHERE date_local IS NOT NULL) d
             CROSS JOIN ({O._values(seeds.FX_RATES, ['currency', 'usd_rate'])}) r)
SELECT date, currency, {_r4('usd_rate')}, false AS is_filled FROM fx
UNION ALL
SELECT s.date, s.currency, {_r4('s.usd_rate', 'usd_rate')}, true FROM src s
WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.date = s.date AND fx.currency = s.currency)""",
                             "fx", "stg_platform_sales"))
def q_fx_spine(c: Chain) -> DataFrame:
    rates = F.array(*[F.struct(F.lit(cur).alias("currency"), F.lit(r).cast("decimal(12,6)").alias("usd_rate"))
                      for cur, r in seeds.FX_RATES])
    days = c.fact_platform_sales.select(F.col("date_local").alias("date")).distinct()
    src = days.select("date", F.inline(rates))
    m = upsert.insert_if_missing(c.fx, src, ["date", "currency"], flag_col="is_filled")
    return m.select("date", "currency", r4("usd_rate"), "is_filled")


@register("calendar_spine", O.sql("""
SELECT c.date, c.market, c.event_name, c.event_kind FROM calendar c
WHERE EXISTS (SELECT 1 FROM stg_platform_sales s WHERE s.date_local = c.date AND s.market = c.market)""",
                                   "calendar", "stg_platform_sales"))
def q_calendar_spine(c: Chain) -> DataFrame:
    days = c.fact_platform_sales.select(F.col("date_local").alias("date"), "market").distinct()
    return c.calendar.join(days, ["date", "market"], "left_semi").select("date", "market", "event_name",
                                                                         "event_kind")


# ------------------------------------------------------------------ data quality
DQ_SQL = {
    "Q01_evc_within_all":
        "SELECT count(*) FROM panel_evc WHERE evc_conversions > all_conversions + 1e-6",
    "Q02_ads_gmv_within_platform":
        "SELECT count(*) FROM (SELECT sum(ads_attributed_gmv_usd) a, max(platform_total_gmv_usd) p FROM panel "
        "WHERE platform_total_gmv_usd IS NOT NULL GROUP BY date_local, market, platform) x WHERE a > 1.05 * p",
    "Q03_no_negatives":
        "SELECT count(*) FROM panel WHERE spend_usd < 0 OR impressions < 0 OR clicks < 0 "
        "OR ads_attributed_orders < 0 OR ads_attributed_gmv_usd < 0",
    "Q04_funnel_order":
        "SELECT count(*) FROM panel WHERE spend_usd > 0 AND (impressions < clicks OR clicks < ads_attributed_orders)",
    "Q05_voucher_within_spend":
        "SELECT count(*) FROM raw_shopee_ads WHERE Voucher_subsidy > Spend + 1e-6",
    "Q06_all_markets":
        "SELECT count(*) FROM dim_market d WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.market = d.market)",
    "Q07_grain_not_null":
        "SELECT count(*) FROM panel WHERE date_local IS NULL OR market IS NULL OR channel IS NULL",
    "Q08_known_channels":
        "SELECT count(*) FROM (SELECT DISTINCT channel FROM panel) p WHERE NOT EXISTS "
        "(SELECT 1 FROM taxonomy t WHERE t.channel = p.channel) AND NOT ends_with(p.channel, '_other')",
    "Q09_direct_orders_within_broad":
        "SELECT count(*) FROM raw_shopee_ads WHERE Direct_orders > Broad_orders",
    "Q10_meta_windows":
        "SELECT count(*) FROM (SELECT DISTINCT attribution_window FROM raw_evc_meta) w WHERE attribution_window "
        "NOT IN ('" + "', '".join(seeds.META_ALLOWED_WINDOWS) + "')",
    "Q11_mega_sale_flag":
        "SELECT count(*) FROM (SELECT DISTINCT date_local AS date, market, is_mega_sale FROM panel) p "
        "LEFT JOIN (SELECT DISTINCT date, market, true AS in_seed FROM calendar) s ON s.date = p.date "
        "AND s.market = p.market WHERE p.is_mega_sale IS DISTINCT FROM coalesce(s.in_seed, false)",
    "Q12_direct_gmv_within_broad":
        "SELECT count(*) FROM panel WHERE direct_gmv_usd IS NOT NULL AND broad_gmv_usd IS NOT NULL "
        "AND direct_gmv_usd > broad_gmv_usd + 1e-6",
    "Q15_fx_coverage":
        "SELECT count(*) FROM (SELECT DISTINCT date_local AS date, currency FROM fact_platform_sales) u "
        "WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.date = u.date AND fx.currency = u.currency)",
}


DQ_SQL |= {f"Q14_unique_{name}": f"SELECT count(*) FROM (SELECT count(*) n FROM {name} GROUP BY {', '.join(key)}) x WHERE n > 1"
           for name, key in facts.KEYS.items()}


@register("dq_suite", O.sql(
    "SELECT chk AS \"check\", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, cast(n AS bigint) AS \"rows\" "
    "FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS chk, ({v}) AS n" for k, v in DQ_SQL.items()) + ") q",
    "panel", "panel_evc", "raw_shopee_ads", "raw_evc_meta", "dim_market", "taxonomy", "calendar",
    "fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads", "fact_evc", "fx"))
def q_dq_suite(c: Chain) -> DataFrame:
    return quality.dq_suite(c.spark, quality.checks(c.stored))


# ------------------------------------------------------------------ features
MEDIA = seeds.PAID_CHANNELS + ["other"]
REG_COLS = [f"{k}_{ch}" for k in ("x", "i") for ch in MEDIA]
REG_CALENDAR = ["is_weekend", "is_payday", "is_mega_sale", "week_of_year"]


def _frame_sql(day: str) -> str:
    """The regression frame, unrounded."""
    paid = ", ".join(f"'{ch}'" for ch in seeds.PAID_CHANNELS)
    name = f"CASE WHEN channel IN ({paid}) THEN channel ELSE 'other' END"
    sums = [f"ln(1 + coalesce(sum(CASE WHEN {name} = '{ch}' THEN {col} END), 0)) AS {k}_{ch}"
            for k, col in (("x", "spend_usd"), ("i", "impressions")) for ch in MEDIA]
    return f"""
SELECT g.market, g.date_local, ln(1 + g.gmv) AS y, {', '.join('s.' + x for x in REG_COLS + REG_CALENDAR)}
FROM (SELECT {day} AS date_local, market, sum(gmv) AS gmv FROM (
        SELECT date_local, market, platform, max(coalesce(platform_total_gmv_usd, 0)) AS gmv FROM panel
        GROUP BY 1, 2, 3) x GROUP BY 1, 2) g
LEFT JOIN (SELECT {day} AS date_local, market, {', '.join(sums)},
        max(cast(is_weekend AS int)) AS is_weekend, max(cast(is_payday AS int)) AS is_payday,
        max(cast(is_mega_sale AS int)) AS is_mega_sale, max(week_of_year) AS week_of_year
      FROM panel GROUP BY 1, 2) s ON s.date_local = g.date_local AND s.market = g.market"""


def _regression_sql(day: str) -> str:
    return (f"SELECT market, date_local, {_r4('y')}, {', '.join(_r4(x) for x in REG_COLS)}, {', '.join(REG_CALENDAR)} "
            f"FROM ({_frame_sql(day)}) f")


def _regression(c: Chain, weekly: bool) -> DataFrame:
    f = features.regression_frame(c.panel, weekly)
    return f.select("market", "date_local", r4("y"), *[r4(x) for x in REG_COLS], *REG_CALENDAR)


@register("regression_frame", O.sql(_regression_sql("date_local"), "panel"))
def q_regression_frame(c: Chain) -> DataFrame:
    return _regression(c, weekly=False)


@register("regression_weekly", O.sql(_regression_sql("cast(date_trunc('week', date_local) AS date)"), "panel"))
def q_regression_weekly(c: Chain) -> DataFrame:
    return _regression(c, weekly=True)


REG_TERMS = REG_COLS + REG_CALENDAR


def _fit_sql(terms: list[str], ridge: float) -> str:
    """Cross products by plain sums, elimination one pivot per recursion."""
    p = len(terms)
    z = ", ".join(f"coalesce({t}, 0)::DOUBLE" for t in [*terms, "y"])
    return f"""
SELECT * FROM (WITH RECURSIVE z AS (SELECT market, [1::DOUBLE, {z}] AS z FROM ({_frame_sql('date_local')}) f),
g AS (SELECT market, i, j, sum(z[i] * z[j]) AS s FROM z, range(1, {p + 3}) a(i), range(1, {p + 3}) b(j) GROUP BY ALL),
n AS (SELECT market, s AS n FROM g WHERE i = 1 AND j = 1),
m AS (SELECT g.market, j - 1 AS i, s / n AS mean FROM g JOIN n USING (market) WHERE g.i = 1 AND j > 1),
c AS (SELECT g.market, g.i - 1 AS i, g.j - 1 AS j, s / n - a.mean * b.mean AS c, a.mean AS mi
      FROM g JOIN n USING (market) JOIN m a ON a.market = g.market AND a.i = g.i - 1
      JOIN m b ON b.market = g.market AND b.i = g.j - 1),
d AS (SELECT market, i, mi, CASE WHEN c > {features.CONSTANT} * (1 + mi * mi) THEN sqrt(c) ELSE 0 END AS d FROM c WHERE i = j),
r AS (SELECT c.market, c.i, c.j, CASE WHEN a.d > 0 AND b.d > 0 THEN c / (a.d * b.d) ELSE 0 END AS r
      FROM c JOIN d a ON a.market = c.market AND a.i = c.i JOIN d b ON b.market = c.market AND b.i = c.j),
e(market, k, a) AS (
  SELECT market, 1, list(row ORDER BY i) FROM (
    SELECT market, i, list(r + CASE WHEN i = j THEN {ridge} ELSE 0 END ORDER BY j) AS row FROM r WHERE i <= {p} GROUP BY market, i) x
  GROUP BY market
  UNION ALL
  SELECT market, k + 1, list_transform(a, lambda row, i: CASE WHEN i = k
      THEN list_transform(row, lambda v: v / a[k][k])
      ELSE list_transform(row, lambda v, j: v - row[k] * a[k][j] / a[k][k]) END)
  FROM e WHERE k <= {p}),
b AS (SELECT market, i, a[i][{p + 1}] AS beta FROM e, range(1, {p + 1}) x(i) WHERE k = {p + 1}),
q AS (SELECT b.market, sum(2 * b.beta * y.r) - any_value(qq.q) AS r2 FROM b
      JOIN r y ON y.market = b.market AND y.i = b.i AND y.j = {p + 1}
      JOIN (SELECT r.market, sum(u.beta * v.beta * r.r) AS q FROM r JOIN b u ON u.market = r.market AND u.i = r.i
            JOIN b v ON v.market = r.market AND v.i = r.j GROUP BY 1) qq ON qq.market = b.market GROUP BY 1),
t AS (SELECT b.market, b.i, b.beta, x.mi, y.mi AS my, y.d AS dy, CASE WHEN x.d > 0 THEN b.beta * y.d / x.d ELSE 0 END AS coef
      FROM b JOIN d x ON x.market = b.market AND x.i = b.i JOIN d y ON y.market = b.market AND y.i = {p + 1}),
o AS (SELECT market, ['{"', '".join(terms)}'][i] AS term, coef AS coefficient, beta FROM t
      UNION ALL SELECT market, '(intercept)', any_value(my) - sum(coef * mi), 0 FROM t GROUP BY market)
SELECT o.market, term, {_r4('coefficient')}, {_r4('beta')}, cast(n AS bigint) AS n,
  {_r4('CASE WHEN y.d > 0 THEN r2 END', 'r2')}
FROM o JOIN n USING (market) JOIN q USING (market) JOIN d y ON y.market = o.market AND y.i = {p + 1}) fit"""


@register("regression_fit", O.sql(_fit_sql(REG_TERMS, features.RIDGE), "panel"))
def q_regression_fit(c: Chain) -> DataFrame:
    fit = features.regression_fit(features.regression_frame(c.panel), REG_TERMS)
    return fit.select("market", "term", r4("coefficient"), r4("beta"), "n", r4("r2"))


# ------------------------------------------------------------------ lift at campaign grain
CAMPAIGN_DAILY_SQL = """
SELECT market, platform, campaign_id, date_local, sum(spend) AS spend, sum(gmv) AS gmv FROM (
  SELECT market, platform, campaign_id, date_local, coalesce(cast(spend_usd AS double), 0) AS spend,
    coalesce(cast(coalesce(broad_gmv_usd, direct_gmv_usd) AS double), 0) AS gmv FROM fact_onplatform_ads
  UNION ALL
  SELECT market, platform, campaign_id, date_local, coalesce(cast(spend_usd AS double), 0),
    coalesce(cast(purchase_value_reported_usd AS double), 0) FROM fact_offplatform_ads) x
GROUP BY 1, 2, 3, 4"""
frag("campaign_daily", ["fact_onplatform_ads", "fact_offplatform_ads"], CAMPAIGN_DAILY_SQL)


def _campaigns(c: Chain) -> DataFrame:
    return lift.campaign_daily(c.fact_onplatform_ads, c.fact_offplatform_ads)


@register("lift_matched_weeks", O.sql(f"""
WITH w AS (SELECT market, platform, campaign_id, cast(date_trunc('week', date_local) AS date) AS week,
             sum(spend) AS spend, sum(gmv) AS gmv FROM campaign_daily GROUP BY 1, 2, 3, 4),
u AS (SELECT w.*, p.spend AS pre_spend, p.gmv AS pre_gmv,
        cast(round(ln(1 + p.spend) / {lift.GRID}) AS int) AS c1, cast(round(ln(1 + p.gmv) / {lift.GRID}) AS int) AS c2,
        EXISTS (SELECT 1 FROM calendar k WHERE k.market = w.market
                AND cast(date_trunc('week', k.date) AS date) = w.week) AS sale
      FROM w JOIN w p ON p.market = w.market AND p.platform = w.platform
        AND p.campaign_id IS NOT DISTINCT FROM w.campaign_id AND p.week = w.week - 7),
cand AS (SELECT market, platform, c1, c2, count(*) AS n, avg(gmv) AS baseline FROM u WHERE NOT sale GROUP BY 1, 2, 3, 4),
best AS (SELECT t.market, t.platform, t.c1, t.c2, c.n, c.baseline,
           (t.c1 - c.c1) * (t.c1 - c.c1) + (t.c2 - c.c2) * (t.c2 - c.c2) AS distance
         FROM (SELECT DISTINCT market, platform, c1, c2 FROM u WHERE sale) t
         JOIN cand c ON c.market = t.market AND c.platform = t.platform
           AND abs(t.c1 - c.c1) <= {lift.CALIPER} AND abs(t.c2 - c.c2) <= {lift.CALIPER}
         QUALIFY row_number() OVER (PARTITION BY t.market, t.platform, t.c1, t.c2 ORDER BY distance, c.c1, c.c2) = 1)
SELECT u.market, u.platform, u.campaign_id, u.week, {_r4('u.spend', 'spend')}, {_r4('u.gmv', 'gmv')},
  {_r4('pre_spend')}, {_r4('pre_gmv')}, b.n AS matched_weeks, b.distance, {_r4('b.baseline', 'baseline_gmv')},
  {_r4('u.gmv - b.baseline', 'lift')},
  {_r4('CASE WHEN b.baseline <> 0 THEN (u.gmv - b.baseline) / b.baseline END', 'lift_share')}
FROM u LEFT JOIN best b USING (market, platform, c1, c2) WHERE sale""", "campaign_daily", "calendar"))
def q_lift_matched_weeks(c: Chain) -> DataFrame:
    f = lift.matched_weeks(_campaigns(c), c.calendar)
    return f.select(*lift.CAMPAIGN, "week", *[r4(x) for x in ("spend", "gmv", "pre_spend", "pre_gmv")], "matched_weeks",
                    "distance", *[r4(x) for x in ("baseline_gmv", "lift", "lift_share")])


@register("lift_on_off", O.sql(f"""
WITH g AS (SELECT date_local, market, sum(gmv) AS gmv FROM (
             SELECT date_local, market, platform, max(coalesce(platform_total_gmv_usd, 0)) AS gmv FROM panel
             GROUP BY 1, 2, 3) x GROUP BY 1, 2),
adj AS (SELECT market, date_local, gmv / (avg(gmv) OVER (PARTITION BY market, dayofweek(date_local))
          / avg(gmv) OVER (PARTITION BY market)) AS adjusted FROM g),
s AS (SELECT market, platform, campaign_id, lag(date_local) OVER (PARTITION BY market, platform, campaign_id ORDER BY date_local) AS last,
        date_local FROM campaign_daily WHERE spend > 0),
sw AS (SELECT market, platform, campaign_id, last + 1 AS off_from, date_local - 1 AS off_to FROM s
       WHERE date_local - last > {lift.LEAST_OFF}),
d AS (SELECT sw.*, cast(unnest(generate_series(off_from - {lift.PRE_DAYS}, off_to, INTERVAL 1 DAY)) AS date) AS day FROM sw),
j AS (SELECT d.*, day >= off_from AS off, adjusted, spend FROM d
      LEFT JOIN adj a ON a.market = d.market AND a.date_local = d.day
      LEFT JOIN campaign_daily c ON c.market = d.market AND c.platform = d.platform AND c.campaign_id = d.campaign_id
        AND c.date_local = d.day),
o AS (SELECT market, platform, campaign_id, off_from, off_to, count(adjusted) FILTER (NOT off) AS pre_days,
        count(adjusted) FILTER (off) AS off_days, avg(adjusted) FILTER (NOT off) AS pre_gmv,
        avg(adjusted) FILTER (off) AS off_gmv, coalesce(sum(spend) FILTER (NOT off), 0) / {lift.PRE_DAYS} AS pre_spend
      FROM j GROUP BY 1, 2, 3, 4, 5)
SELECT market, platform, campaign_id, off_from, off_to, pre_days, off_days, {_r4('pre_gmv')}, {_r4('off_gmv')},
  {_r4('pre_spend')}, {_r4('pre_gmv - off_gmv', 'lift')},
  {_r4('CASE WHEN pre_spend <> 0 THEN (pre_gmv - off_gmv) / pre_spend END', 'return_on_spend')} FROM o""",
                                "campaign_daily", "panel"))
def q_lift_on_off(c: Chain) -> DataFrame:
    f = lift.on_off(_campaigns(c), features.daily_market_gmv(c.panel))
    return f.select(*lift.CAMPAIGN, "off_from", "off_to", "pre_days", "off_days",
                    *[r4(x) for x in ("pre_gmv", "off_gmv", "pre_spend", "lift", "return_on_spend")])


LIFT_TREATED = ["ID", "MY"]
LIFT_PRE = (dt.date(2024, 1, 3), dt.date(2024, 1, 9))
LIFT_POST = (dt.date(2024, 1, 10), dt.date(2024, 1, 14))


@register("lift_did", O.sql(f"""
WITH g AS (SELECT date_local, market, sum(gmv) AS gmv FROM (
             SELECT date_local, market, platform, max(coalesce(platform_total_gmv_usd, 0)) AS gmv FROM panel
             GROUP BY 1, 2, 3) x GROUP BY 1, 2),
l AS (SELECT *, CASE WHEN market IN ('{"', '".join(LIFT_TREATED)}') THEN 'treated' ELSE 'control' END AS grp,
        CASE WHEN date_local BETWEEN DATE '{LIFT_PRE[0]}' AND DATE '{LIFT_PRE[1]}' THEN 'pre'
             WHEN date_local BETWEEN DATE '{LIFT_POST[0]}' AND DATE '{LIFT_POST[1]}' THEN 'post' END AS period
      FROM g),
a AS (SELECT avg(CASE WHEN grp = 'treated' AND period = 'pre' THEN gmv END) AS treated_pre,
        avg(CASE WHEN grp = 'treated' AND period = 'post' THEN gmv END) AS treated_post,
        avg(CASE WHEN grp = 'control' AND period = 'pre' THEN gmv END) AS control_pre,
        avg(CASE WHEN grp = 'control' AND period = 'post' THEN gmv END) AS control_post
      FROM l WHERE period IS NOT NULL)
SELECT {_r4('treated_pre')}, {_r4('treated_post')}, {_r4('control_pre')}, {_r4('control_post')},
  {_r4('(treated_post - treated_pre) - (control_post - control_pre)', 'did')} FROM a""", "panel"))
def q_lift_did(c: Chain) -> DataFrame:
    d = features.lift_did(c.panel, LIFT_TREATED, LIFT_PRE, LIFT_POST)
    return d.select(*[r4(x) for x in ("treated_pre", "treated_post", "control_pre", "control_post", "did")])


@register("traffic_organic", O.sql(f"""
SELECT f.date_local, f.market, 'tiktok_shop_' || l.traffic_source AS channel,
  {_r4('sum(f.gmv_net_usd * l.cnt / f.orders_gross)', 'gmv_usd')}
FROM fact_platform_sales f JOIN fact_sales_l1 l ON l.date_local = f.date_local AND l.market = f.market
  AND l.platform = f.platform AND l.shop_id = f.shop_id AND l.sku_id = f.sku_id
WHERE f.platform = 'tiktok_shop' AND l.traffic_source IN ('live', 'video')
GROUP BY 1, 2, 3""", "fact_platform_sales", "fact_sales_l1"))
def q_traffic_organic(c: Chain) -> DataFrame:
    t = features.traffic_split_organic(c.fact_platform_sales)
    return t.select("date_local", "market", "channel", r4("gmv_usd"))


@register("keyword_fact", O.sql(f"""
SELECT date_local, market, platform, ad_type, campaign_id, sku_id, ad_key, {_r4('sum(spend_usd)', 'spend_usd')},
  cast(sum(impressions) AS bigint) AS impressions, cast(sum(clicks) AS bigint) AS clicks,
  cast(sum(broad_orders) AS bigint) AS broad_orders, {_r4('sum(broad_gmv_usd)', 'broad_gmv_usd')}
FROM stg_onplatform_ads
GROUP BY date_local, market, platform, ad_type, campaign_id, sku_id, ad_key""", "stg_onplatform_ads"))
def q_keyword_fact(c: Chain) -> DataFrame:
    k = features.keyword_fact(c.stg_onplatform_ads)
    return k.select("date_local", "market", "platform", "ad_type", "campaign_id", "sku_id", "ad_key",
                    r4("spend_usd"), "impressions", "clicks", "broad_orders", r4("broad_gmv_usd"))


# ------------------------------------------------------------------ IO6 envelopes
ENV_FIELDS = ["Date", "Advertiser_id", "Campaign_id", "Ad_group_id", "Ad_id", "Spend", "Impressions", "Clicks",
              "Complete_payment", "Complete_payment_value", "ingested_at"]


@register("envelope_flatten", O.sql(f"""
SELECT "Date", Advertiser_id, Campaign_id, Ad_group_id, Ad_id, {_r4('Spend')}, Impressions, Clicks,
  Complete_payment, {_r4('Complete_payment_value')}, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM raw_tiktok_ads""", "raw_tiktok_ads"))
def q_envelope_flatten(c: Chain) -> DataFrame:
    raw = c.raw["tiktok_ads_daily"]
    # API pages: one envelope per (market, day, block of 64 ad ids); the ad id
    # is unique per event, so a page never exceeds 128 rows (with restatements).
    page = [F.col("Country_code"), F.col("Date"),
            F.floor(F.regexp_extract("Ad_id", r"(\d+)$", 1).cast("long") / 64)]
    landing = io.envelope_pages(raw, ENV_FIELDS, page)
    rec = io.typed_records(io.flatten_envelope(landing),
                           schemas.TIKTOK_ADS_DAILY.__class__([f for f in schemas.TIKTOK_ADS_DAILY.fields
                                                               if f.name in ENV_FIELDS]))
    return rec.select("Date", "Advertiser_id", "Campaign_id", "Ad_group_id", "Ad_id", r4("Spend"), "Impressions",
                      "Clicks", "Complete_payment", r4("Complete_payment_value"),
                      F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))
