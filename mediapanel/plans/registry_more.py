"""Registered queries of the refresh, the landing formats, the conversion
toggle, budgets, reports and long series, with oracles."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT as P
from ..operators import conform
from ..operators import decisions as D
from ..operators import metrics as M
from ..operators import panel as PN
from ..operators import response as R
from ..session import ensure_checkpoint_dir
from ..sources import bind, io, schemas, seeds
from . import oracle as O
from .chain import Chain
from .registry import EVC_MONEY, EVC_OUT, ORACLE, PANEL_MONEY, PANEL_OUT, _r4, r4, register
from .registry_analytics import RANGE_LO, SCAN_LO, _kpi_sql
from .registry_decisions import DOM, MD
from .registry_misc import FIRST_LOAD_CUTOFF, REFRESH_DAYS, REFRESH_LO
from .reports import channel_brief, daily_report, long_form

frag = O.frag


# ------------------------------------------------------------------ daily job
# First load: all days before the window, and what had been ingested by the
# cutoff. Second load: everything, restated rows included, but for one
# campaign that the provider no longer reports.
GONE = "cmp-3"
FIRST = f"ingest_ts < TIMESTAMP '{FIRST_LOAD_CUTOFF}' OR {{day}} < DATE '{REFRESH_LO - dt.timedelta(days=1)}'"
O.variant("first", {"event_base": f"SELECT * FROM event_base WHERE {FIRST.format(day='d')}",
                    "order_base": f"SELECT * FROM order_base WHERE {FIRST.format(day='cast(create_ts AS date)')}"},
          ["fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads"])
O.variant("second", {"event_base": f"SELECT * FROM event_base WHERE campaign <> '{GONE}'"},
          ["fact_onplatform_ads", "fact_offplatform_ads"])


def _merged_sql(name: str, second: str) -> str:
    from ..operators.facts import KEYS
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in KEYS[name])
    src = f"(SELECT * FROM {second} WHERE date_local >= DATE '{REFRESH_LO}')"
    return (f"SELECT * FROM {src} UNION ALL BY NAME SELECT t.* FROM {name}_first t "
            f"WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE {same})")


for _name, _second in (("fact_platform_sales", "fact_platform_sales"), ("fact_onplatform_ads", "fact_onplatform_ads_second"),
                       ("fact_offplatform_ads", "fact_offplatform_ads_second")):
    frag(f"{_name}_refreshed", [f"{_name}_first", _second], _merged_sql(_name, _second))
O.variant("merged", {n: f"SELECT * FROM {n}_refreshed" for n in
                     ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads")}, ["panel"])
for _name in ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads"):
    O.F[f"{_name}_merged"] = ([f"{_name}_refreshed"], O.F[f"{_name}_merged"][1])


@register("daily_refresh", O.sql("SELECT " + ", ".join(_r4(c) if c in PANEL_MONEY else c for c in PANEL_OUT)
                                 + " FROM panel_merged", "panel_merged"))
def q_daily_refresh(c: Chain) -> DataFrame:
    """The panel after a second load with restated, new and vanished keys."""
    def first(df, day):
        cut = F.lit(FIRST_LOAD_CUTOFF).cast("timestamp")
        return df.where((F.col("ingested_at") < cut) | (F.col(day) < F.lit(REFRESH_LO - dt.timedelta(days=1))))
    feeds = ("shopee_orders", "tiktok_shop_orders", "tiktok_ads_daily", "shopee_ads_daily", "meta_cpas_daily",
             "google_ads_shopee_daily")
    old = Chain(c.spark, c.sf_dir, c.p, False)
    old.raw = c.raw.with_feeds(**{n: first(c.raw[n], "Date") for n in feeds})
    new = Chain(c.spark, c.sf_dir, c.p, False)
    new.raw = c.raw.with_feeds(**{n: c.raw[n].where(F.col("Campaign_id") != GONE) for n in feeds[2:]})
    names = ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads")
    merged = new.merged_facts({n: getattr(old, n) for n in names}, REFRESH_DAYS, 365, whole=True)
    p = PN.daily_channel_panel(*[merged[n] for n in names], c.calendar)
    return p.select(*[r4(x) if x in PANEL_MONEY else x for x in PANEL_OUT])


@register("published_refresh", O.sql("SELECT " + ", ".join(_r4(c) if c in EVC_MONEY else c for c in EVC_OUT)
                                     + " FROM panel_evc", "panel_evc"))
def q_published_refresh(c: Chain) -> DataFrame:
    """The published conversion panel after a first load of what had been
    ingested by the cutoff and a refresh of the days touched since."""
    old = Chain(c.spark, c.sf_dir, c.p, False)
    old.raw = c.landed.raw.with_feeds(**{n: c.landed.raw[n].where(F.col("ingested_at") < F.lit(FIRST_LOAD_CUTOFF))
                                         for n in bind.RAW_BUILDERS})
    store = old.publish(f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/mediapanel-{uuid.uuid4().hex[:12]}")
    c.landed.refresh_published(store, replace_days=True)
    return store.read("panel_evc").select(*[r4(x) if x in EVC_MONEY else x for x in EVC_OUT])


# ------------------------------------------------------------------ conversion toggle (PF14)
frag("scan_evc", ["panel_evc", "taxonomy"], f"""
SELECT p.date_local, p.market, p.channel, coalesce(p.platform, t.platform, 'shopee') AS platform, p.spend_usd,
  cast(coalesce(p.ads_attributed_orders, 0) AS double) + coalesce(p.evc_conversions, 0) AS ads_orders,
  coalesce(p.ads_attributed_gmv_usd, 0) + coalesce(p.evc_gmv_usd, 0) AS ads_gmv_usd,
  coalesce(p.evc_conversions, 0) AS evc_conversions, coalesce(p.evc_gmv_usd, 0) AS evc_gmv_usd,
  p.platform_total_gmv_usd, p.platform_total_orders
FROM panel_evc p LEFT JOIN taxonomy t ON t.channel = p.channel
WHERE p.date_local BETWEEN DATE '{SCAN_LO}' AND DATE '{P.as_of}'
""")
frag("filtered_evc", ["scan_evc"], f"SELECT * FROM scan_evc WHERE date_local >= DATE '{RANGE_LO}'")
EVC_SCAN = ["spend_usd", "ads_orders", "ads_gmv_usd", "evc_conversions", "evc_gmv_usd"]


def _evc_scan(c: Chain) -> tuple[DataFrame, object]:
    p = replace(c.p, evc=True)
    return M.scan_panel(c.panel_evc, c.taxonomy, p), p


@register("panel_scan_evc", O.sql(f"""
SELECT date_local, market, channel, platform, {', '.join(_r4(x) for x in EVC_SCAN)} FROM scan_evc""", "scan_evc"))
def q_panel_scan_evc(c: Chain) -> DataFrame:
    return _evc_scan(c)[0].select("date_local", "market", "channel", "platform", *[r4(x) for x in EVC_SCAN])


@register("kpi_blended_evc", O.sql(f"""
SELECT {_r4('spend')}, {_r4('gmv')}, orders, {_r4('ads_gmv')}, {_r4('roas')}
FROM ({_kpi_sql('filtered_evc', [])}) k""", "filtered_evc"))
def q_kpi_blended_evc(c: Chain) -> DataFrame:
    scan, p = _evc_scan(c)
    k = M.kpis(M.filter_range(scan, p))
    return k.select(r4("spend"), r4("gmv"), "orders", r4("ads_gmv"), r4("roas"))


# ------------------------------------------------------------------ wider windows
WIDE = 30
WIDE_LO = P.as_of - dt.timedelta(days=WIDE - 1)
WIDE_PREV = P.as_of - dt.timedelta(days=2 * WIDE - 1)


@register("period_compare_30d", O.sql(f"""
SELECT channel, period, {_r4('spend')}, {_r4('ads_gmv')}, cast(impressions AS bigint) AS impressions,
  cast(clicks AS bigint) AS clicks, {_r4('CASE WHEN spend > 0 THEN ads_gmv / spend ELSE 0 END', 'roas')}
FROM (SELECT p.channel, CASE WHEN p.date_local >= DATE '{WIDE_LO}' THEN 'now' ELSE 'prev' END AS period,
        sum(p.spend_usd) AS spend, sum(coalesce(p.ads_attributed_gmv_usd, 0)) AS ads_gmv,
        sum(coalesce(p.impressions, 0)) AS impressions, sum(coalesce(p.clicks, 0)) AS clicks
      FROM panel p LEFT JOIN taxonomy t ON t.channel = p.channel
      WHERE p.date_local BETWEEN DATE '{WIDE_PREV}' AND DATE '{P.as_of}'
        AND coalesce(t.grp, 'on_platform') <> 'organic' GROUP BY 1, 2) x""", "panel", "taxonomy"))
def q_period_compare_30d(c: Chain) -> DataFrame:
    p = replace(c.p, range_days=WIDE)
    d = M.period_compare(M.scan_panel(c.panel, c.taxonomy, p), p)
    return d.select("channel", "period", r4("spend"), r4("ads_gmv"), F.col("impressions").cast("long").alias("impressions"),
                    F.col("clicks").cast("long").alias("clicks"), r4("roas"))


LONG_HALFLIFE = 60.0


@register("adstock_long", O.sql(f"""
WITH s0 AS (
  SELECT {O.MK}[c_nationkey % 6 + 1] AS market, CASE WHEN o_orderkey % 2 = 0 THEN 'meta_cpas' ELSE 'tiktok_ads' END AS channel,
    cast(o_orderdate AS date) AS date_local, sum(cast(round(o_totalprice * 100) AS bigint)) / 100000.0 AS spend
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
sp AS (SELECT market, channel, cast(unnest(generate_series(min(date_local), max(date_local), INTERVAL 1 DAY)) AS date) AS date_local
       FROM s0 GROUP BY market, channel),
s AS (SELECT sp.*, coalesce(s0.spend, 0) AS spend FROM sp LEFT JOIN s0 USING (market, channel, date_local))
SELECT a.market, a.channel, a.date_local, {_r4('a.spend', 'spend')},
  {_r4(f"sum(b.spend * pow(0.5, datediff('day', b.date_local, a.date_local) / {LONG_HALFLIFE}))", 'adstock')}
FROM s a JOIN s b ON a.market = b.market AND a.channel = b.channel AND b.date_local <= a.date_local
GROUP BY a.market, a.channel, a.date_local, a.spend"""))
def q_adstock_long(c: Chain) -> DataFrame:
    """Daily order value over all years as a series with a long half-life."""
    o = bind.read_table(c.spark, c.sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cu = bind.read_table(c.spark, c.sf_dir, "customer").select("c_custkey", "c_nationkey")
    day = o.join(cu, o.o_custkey == cu.c_custkey).groupBy(
        F.expr(f"element_at({bind._MK}, cast(c_nationkey % 6 AS int) + 1)").alias("market"),
        F.when(F.col("o_orderkey") % 2 == 0, "meta_cpas").otherwise("tiktok_ads").alias("channel"),
        F.col("o_orderdate").cast("date").alias("date_local")).agg(
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / F.lit(100000.0)).alias("spend_usd"))
    pr = c.spark.createDataFrame([("meta_cpas", LONG_HALFLIFE), ("tiktok_ads", LONG_HALFLIFE)], "channel string, halflife double")
    a = R.adstock(day, pr)
    return a.select("market", "channel", "date_local", r4("spend"), r4("adstock"))


# ------------------------------------------------------------------ reports
def _unpivot_sql(name: str, sql: str, item: str | None, day: bool, metrics: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS section, {f'cast({item} AS varchar)' if item else 'CAST(NULL AS varchar)'} AS item, "
        f"{'date_local' if day else 'CAST(NULL AS date)'} AS date_local, '{m}' AS metric, {_r4(m, 'value')} FROM ({sql}) q"
        for m in metrics)


BRIEF_KEYS = {"period_compare": "period", "by_market": "market", "trend": None, "heatmap": "market"}
FUNNEL = ["spend", "ads_gmv", "impressions", "clicks", "orders", "roas", "ctr", "cvr"]
frag("brief_rows", ["filtered"], f"SELECT * FROM filtered WHERE channel = '{P.focus_channel}'")
BY_MARKET_SQL = O.sql(f"""
SELECT d.market, coalesce(k.spend, 0) AS spend, coalesce(k.gmv, 0) AS gmv, coalesce(k.orders, 0) AS orders,
  coalesce(k.ads_gmv, 0) AS ads_gmv, coalesce(k.roas, 0) AS roas
FROM dim_market d LEFT JOIN ({_kpi_sql('brief_rows', ['market'])}) k ON k.market = d.market""", "brief_rows", "dim_market")


@register("channel_brief", "\nUNION ALL\n".join([
    _unpivot_sql("period_compare", f"SELECT * FROM ({ORACLE['period_compare']}) z WHERE channel = '{P.focus_channel}'",
                 "period", False, FUNNEL),
    _unpivot_sql("by_market", BY_MARKET_SQL, "market", False, ["spend", "gmv", "orders", "ads_gmv", "roas"]),
    _unpivot_sql("trend", ORACLE["channel_trend"], None, True, ["spend", "roas"]),
    _unpivot_sql("heatmap", ORACLE["heatmap"], "market", True, ["value", "max_value"])]))
def q_channel_brief(c: Chain) -> DataFrame:
    return long_form(channel_brief(c), BRIEF_KEYS).select("section", "item", "date_local", "metric", r4("value"))


REPORT = {"daily_series": (None, True, ["spend", "gmv"]), "top_channel_stack": ("channel", True, ["spend", "rank"]),
          "share_divergence": ("channel", False, ["spend_share", "gmv_share", "share_diff", "is_divergent"]),
          "attribution_roas": ("channel", False, ["spend", "direct_roas", "broad_roas", "ads_roas"]),
          "promo_days": ("market", True, ["is_payday", "is_mega_sale"])}


@register("daily_report", "\nUNION ALL\n".join(
    _unpivot_sql(n, "SELECT * REPLACE (" + ", ".join(f"cast({m} AS int) AS {m}" for m in ms if m.startswith("is_"))
                 + f") FROM ({ORACLE[n]}) y" if any(m.startswith("is_") for m in ms) else ORACLE[n], item, day, ms)
    for n, (item, day, ms) in REPORT.items()))
def q_daily_report(c: Chain) -> DataFrame:
    keys = {n: item for n, (item, _, _) in REPORT.items()}
    return long_form(daily_report(c), keys).select("section", "item", "date_local", "metric", r4("value"))


# ------------------------------------------------------------------ budgets
DIAL_PLANS = [("gmv", 2_000_000.0), ("spend", 10_000.0), ("spend", 2_500.0), ("orders", 900.0)]
CHANNEL_PLANS = [("meta_cpas", 1_000.0), ("google_ads_shopee", 2_000.0), ("tiktok_ads", 0.5)]


@register("pacing_budget", O.sql(f"""
WITH k AS ({_kpi_sql('month_rows', [])}),
b AS (SELECT metric, sum(plan) AS plan FROM ({O._values(DIAL_PLANS, ['metric', 'plan'])}) x GROUP BY 1),
u AS (SELECT 'gmv' AS metric, gmv AS actual, gmv * {MD} / {DOM} AS forecast FROM k
      UNION ALL SELECT 'spend', spend, spend * {MD} / {DOM} FROM k
      UNION ALL SELECT 'orders', cast(orders AS double), orders * {MD} / {DOM} FROM k
      UNION ALL SELECT 'roas', roas, roas FROM k),
v AS (SELECT u.*, coalesce(b.plan, 0) AS plan, CASE WHEN b.plan > 0 THEN forecast / b.plan ELSE 0 END AS ratio
      FROM u LEFT JOIN b ON b.metric = u.metric)
SELECT metric, {_r4('actual')}, {_r4('plan')}, {_r4('forecast')}, {_r4('ratio', 'pace_ratio')},
  CASE WHEN ratio < {seeds.PACING_BAND[0]} THEN 'behind' WHEN ratio > {seeds.PACING_BAND[1]} THEN 'over' ELSE 'on' END AS status
FROM v""", "month_rows"))
def q_pacing_budget(c: Chain) -> DataFrame:
    d = D.pacing(c.scan, c.p, c.spark.createDataFrame(DIAL_PLANS, "metric string, plan double"))
    return d.select("metric", r4("actual"), r4("plan"), r4("forecast"), r4("pace_ratio"), "status")


@register("channel_pacing_budget", O.sql(f"""
WITH a AS (
  SELECT t.channel, coalesce(s.actual, 0) AS actual, coalesce(s.actual, 0) * {MD} / {DOM} AS forecast, coalesce(b.plan, 0) AS plan
  FROM taxonomy t LEFT JOIN (SELECT channel, sum(spend_usd) AS actual FROM month_rows GROUP BY 1) s ON s.channel = t.channel
  LEFT JOIN ({O._values(CHANNEL_PLANS, ['channel', 'plan'])}) b ON b.channel = t.channel
  WHERE t.grp <> 'organic')
SELECT channel, {_r4('actual')}, {_r4('plan')}, {_r4('forecast')}, {_r4('forecast / greatest(plan, 1)', 'pace_ratio')},
  CASE WHEN forecast / greatest(plan, 1) < {seeds.PACING_BAND[0]} THEN 'behind'
       WHEN forecast / greatest(plan, 1) > {seeds.PACING_BAND[1]} THEN 'over' ELSE 'on' END AS status
FROM a""", "month_rows", "taxonomy"))
def q_channel_pacing_budget(c: Chain) -> DataFrame:
    d = D.channel_pacing(c.scan, c.taxonomy, c.p, c.spark.createDataFrame(CHANNEL_PLANS, "channel string, plan double"))
    return d.select("channel", r4("actual"), r4("plan"), r4("forecast"), r4("pace_ratio"), "status")


# ------------------------------------------------------------------ landing formats
def _folder(c: Chain, name: str) -> str:
    return f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/mediapanel-{name}-{uuid.uuid4().hex[:12]}"


LANDED = ["Date", "Advertiser_id", "Campaign_id", "Ad_group_id", "Ad_id", "Impressions", "Clicks"]


@register("landing_round_trip", O.sql(f"""
SELECT {', '.join(f'"{x}"' for x in LANDED)}, {_r4('Spend')}, _market, strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM raw_tiktok_ads""", "raw_tiktok_ads"))
def q_landing_round_trip(c: Chain) -> DataFrame:
    """IO4 then IO3: rows written as <market>/<day>.ndjson and replayed."""
    root = _folder(c, "landing")
    io.write_landing(c.raw["tiktok_ads_daily"], root, "tiktok_ads")
    back = io.replay_landing(c.spark, root, "tiktok_ads", schemas.TIKTOK_ADS_DAILY)
    return back.select(*LANDED, r4("Spend"), "_market",
                       F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


CSV = ["Date", "Account_id", "Campaign_id", "Adset_id", "Ad_id", "Impressions", "Purchase"]


@register("csv_round_trip", O.sql(f"""
SELECT {', '.join(f'"{x}"' for x in CSV)}, {_r4('Spend')}, _market FROM raw_meta""", "raw_meta"))
def q_csv_round_trip(c: Chain) -> DataFrame:
    """IO5: the CSV sink, read back with the declared types."""
    path = _folder(c, "csv")
    raw = c.raw["meta_cpas_daily"]
    declared = [f.name for f in schemas.META_CPAS_DAILY.fields]
    io.write_csv(raw, path, declared)
    order = io.csv_columns(raw, declared)
    text = c.spark.read.option("header", True).option("enforceSchema", False).csv(path).select(*order)
    types = {f.name: f.dataType for f in raw.schema.fields}
    return text.select(*[F.col(x).cast(types[x]).alias(x) for x in CSV],
                       r4(F.col("Spend").cast("double"), "Spend"), "_market")


@register("extract_window", O.sql(f"""
SELECT "Date", Account_id, Campaign_id, Ad_id, {_r4('Spend')}, 'meta_api' AS _source_system,
  CASE WHEN right(Account_id, 2) = 'SG' THEN NULL ELSE right(Account_id, 2) END AS _market, Account_id AS _accounts,
  DATE '{P.as_of - dt.timedelta(days=13)}' AS _window_start, DATE '{P.as_of}' AS _window_end
FROM raw_meta WHERE "Date" BETWEEN DATE '{P.as_of - dt.timedelta(days=13)}' AND DATE '{P.as_of}'""", "raw_meta"))
def q_extract_window(c: Chain) -> DataFrame:
    """IO7: the rolling window, tagged with lineage; one market's account is not mapped."""
    accounts = c.dim_market.where(F.col("market") != "SG").select(
        F.concat(F.lit("act-"), F.col("market")).alias("account_id"), "market")
    rows = io.extract_window(c.raw["meta_cpas_daily"], "Date", c.p.as_of).select("Date", "Account_id", "Campaign_id", "Ad_id", "Spend")
    t = io.tag_lineage(rows, "meta_api", accounts, c.p.as_of, account_col="Account_id")
    return t.select("Date", "Account_id", "Campaign_id", "Ad_id", r4("Spend"), "_source_system", "_market", "_accounts",
                    "_window_start", "_window_end")


FILTERS = [{"field": "Campaign_name", "op": "STARTS_WITH", "value": "SHP"},
           {"field": "Campaign_type", "op": "IN_LIST", "value": ["SEARCH", "PMAX", "VIDEO"]},
           {"field": "Final_url", "op": "CONTAINS", "value": "example"}]


@register("source_filters", O.sql(f"""
SELECT Campaign_name, Campaign_type, Final_url, count(*) AS n, {_r4('sum(Spend)', 'spend')} FROM raw_google
WHERE starts_with(Campaign_name, 'SHP') AND Campaign_type IN ('SEARCH', 'PMAX', 'VIDEO') AND contains(Final_url, 'example')
GROUP BY 1, 2, 3""", "raw_google"))
def q_source_filters(c: Chain) -> DataFrame:
    """IO8: declarative filters of a source."""
    g = c.raw["google_ads_shopee_daily"].where(io.compile_filters(FILTERS))
    return g.groupBy("Campaign_name", "Campaign_type", "Final_url").agg(
        F.count(F.lit(1)).alias("n"), r4(F.sum("Spend"), "spend"))


@register("account_fan_out", O.sql(f"""
SELECT Customer_id, "Date", count(*) AS n, cast(sum(Clicks) AS bigint) AS clicks FROM raw_google
WHERE Customer_id IN ('cus-TH', 'cus-ID', 'cus-SG') GROUP BY 1, 2""", "raw_google"))
def q_account_fan_out(c: Chain) -> DataFrame:
    """IO9: rows of the accounts configured for the source (under its other
    name, D19); accounts without rows and other sources' accounts do nothing."""
    config = c.spark.createDataFrame([("google_ads", "TH", ["cus-TH", "cus-none"]), ("google_ads", "ID", ["cus-ID"]),
                                      ("google_ads_shopee", "SG", ["cus-SG", "cus-SG"]), ("meta_cpas", "MY", ["cus-MY"])],
                                     "source string, market string, account_ids array<string>")
    g = io.restrict_to_accounts(c.raw["google_ads_shopee_daily"], io.accounts_for(config, "google_ads_shopee"), "Customer_id")
    return g.groupBy("Customer_id", "Date").agg(F.count(F.lit(1)).alias("n"), F.sum("Clicks").alias("clicks"))


@register("real_rows", O.sql(f"""
SELECT Campaign_id, count(*) AS n, {_r4('sum(Spend)', 'spend')} FROM raw_tiktok_ads
WHERE Campaign_id NOT IN ('cmp-1', 'cmp-2') GROUP BY 1""", "raw_tiktok_ads"))
def q_real_rows(c: Chain) -> DataFrame:
    """PF16: rows of simulated systems go, rows without a system stay."""
    system = (F.when(F.col("Campaign_id").isin("cmp-1", "cmp-2"), F.concat("_source_system", F.lit("_sim")))
              .when(F.col("Campaign_id") != "cmp-4", F.col("_source_system")))
    real = conform.exclude_simulated(c.raw["tiktok_ads_daily"].withColumn("_source_system", system))
    return real.groupBy("Campaign_id").agg(F.count(F.lit(1)).alias("n"), r4(F.sum("Spend"), "spend"))
