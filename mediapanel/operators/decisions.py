"""Decomposition, pacing and reallocation rules on the weekly story.

R5-R10, W5, T5. Inputs are the channel deltas (one row per paid channel) or
the scanned panel; all frames are bounded by the taxonomy or the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from ..sources import seeds as S
from ..sources.seeds import PAID_CHANNELS
from .metrics import kpis, last_dates, market_filter, with_scalar

LEVERS = ["impressions", "ctr", "cvr", "aov"]


def lever_bridge(scan: DataFrame, p: Params) -> DataFrame:
    """Split each paid channel's attributed-GMV change between the last 7
    and the 7 prior distinct dates over impressions, CTR, CVR and AOV by log
    share. A lever whose value is not positive in either week contributes 0;
    a zero total log change gives all-zero contributions."""
    d = last_dates(scan, 14)
    d = d.select("date_local", F.when(F.col("date_rank") <= 7, "now").otherwise("prev").alias("wk"))
    r = market_filter(scan, p.market).join(F.broadcast(d), "date_local") \
        .where(F.col("channel").isin(*PAID_CHANNELS))

    def wsum(c, wk):
        return F.sum(F.when(F.col("wk") == wk, F.col(c)).otherwise(0)).cast("double")
    g = r.groupBy("channel").agg(
        *[wsum(c, wk).alias(f"{n}_{wk}") for wk in ("now", "prev")
          for c, n in (("impressions", "impr"), ("clicks", "clk"), ("ads_orders", "ord"), ("ads_gmv_usd", "gmv"))])
    for wk in ("now", "prev"):
        g = g.withColumn(f"impressions_{wk}", F.col(f"impr_{wk}")) \
             .withColumn(f"ctr_{wk}", X.ratio0(f"clk_{wk}", f"impr_{wk}")) \
             .withColumn(f"cvr_{wk}", X.ratio0(f"ord_{wk}", f"clk_{wk}")) \
             .withColumn(f"aov_{wk}", X.ratio0(f"gmv_{wk}", f"ord_{wk}"))

    def ln_ratio(k):
        n, pv = F.col(f"{k}_now"), F.col(f"{k}_prev")
        return F.when((pv > 0) & (n > 0), F.log(n / pv)).otherwise(F.lit(0.0))
    for k in LEVERS:
        g = g.withColumn(f"ln_{k}", ln_ratio(k))
    tot = sum((F.col(f"ln_{k}") for k in LEVERS), F.lit(0.0))
    g = g.withColumn("tot_ln", tot).withColumn("d_gmv", F.col("gmv_now") - F.col("gmv_prev"))
    stack = ", ".join(f"'{k}', {i}, prev_{k}, now_{k}, ln_{k}" for i, k in enumerate(LEVERS))
    g = g.select("channel", "tot_ln", "d_gmv",
                 *[F.col(f"{k}_{w}").alias(f"{w}_{k}") for k in LEVERS for w in ("now", "prev")],
                 *[f"ln_{k}" for k in LEVERS])
    long = g.selectExpr("channel", "tot_ln", "d_gmv",
                        f"stack(4, {stack}) AS (lever, lever_order, prev_value, now_value, ln_value)")
    share = F.when(F.col("tot_ln") != 0, F.col("ln_value") / F.col("tot_ln")).otherwise(F.lit(0.0))
    return long.select("channel", "lever", "lever_order", "prev_value", "now_value",
                       (F.col("d_gmv") * share).alias("contribution"))


def waterfall(deltas: DataFrame, blended: DataFrame, p: Params) -> DataFrame:
    """R6 + W5 (+ D13): prior-week GMV, the largest attributed-GMV deltas of
    channels with enough spend, 'Other', an 'Unattributed' balancing step
    (``compat`` drops it), this-week GMV; with running bar bottoms and tops."""
    d = deltas.withColumn("delta", F.col("gmv_now") - F.col("gmv_prev"))
    eligible = (F.col("spend_now") > p.waterfall_min_spend) | (F.col("spend_prev") > p.waterfall_min_spend)
    ranked = d.withColumn("_r", F.when(eligible, F.row_number().over(
        Window.partitionBy(eligible).orderBy(F.abs("delta").desc(), F.col("spend_now").desc(), "tax_order"))))
    top = ranked.where(eligible & (F.col("_r") <= p.top_n_waterfall)).select(
        F.col("_r").alias("step"), F.col("label"), F.lit("channel").alias("item"), F.col("delta").alias("value"))
    other = ranked.where(~eligible | (F.col("_r") > p.top_n_waterfall)).agg(
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("value"))
    b = blended.select("gmv_prev", "gmv_now")
    items = [
        b.select(F.lit(0).alias("step"), F.lit("Prior wk").alias("label"), F.lit("start").alias("item"),
                 F.col("gmv_prev").alias("value")),
        with_scalar(top, b.select(F.lit(1).alias("_b"))).drop("_b"),
        with_scalar(other, b.select(F.lit(1).alias("_b"))).select(
            F.lit(p.top_n_waterfall + 1).alias("step"), F.lit("Other").alias("label"),
            F.lit("other").alias("item"), "value"),
    ]
    if not p.compat:
        tot_top = top.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("_t"))
        bal = with_scalar(with_scalar(b, tot_top), other.withColumnRenamed("value", "_o")).select(
            F.lit(p.top_n_waterfall + 2).alias("step"), F.lit("Unattributed").alias("label"),
            F.lit("unattributed").alias("item"),
            (F.col("gmv_now") - F.col("gmv_prev") - F.col("_t") - F.col("_o")).alias("value"))
        items.append(bal)
    items.append(b.select(F.lit(p.top_n_waterfall + 3).alias("step"), F.lit("This wk").alias("label"),
                          F.lit("end").alias("item"), F.col("gmv_now").alias("value")))
    u = items[0]
    for x in items[1:]:
        u = u.unionByName(x)
    # Running total in step order (a start or end bar resets it).
    step = F.when(F.col("item").isin("start", "end"), F.lit(0.0)).otherwise(F.col("value"))
    base = F.when(F.col("item") == "start", F.col("value"))
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumn("_start", F.max(base).over(Window.partitionBy(F.lit(1))))
    u = u.withColumn("_after", F.col("_start") + F.sum(step).over(w))
    u = u.withColumn("_before", F.col("_after") - step)
    kind = F.when(F.col("item").isin("start", "end"), F.col("item")) \
            .when(F.col("value") >= 0, "plus").otherwise("minus")
    bottom = F.when(F.col("item").isin("start", "end"), F.lit(0.0)) \
              .when(F.col("value") >= 0, F.col("_before")).otherwise(F.col("_after"))
    top_ = F.when(F.col("item").isin("start", "end"), F.col("value")) \
            .when(F.col("value") >= 0, F.col("_after")).otherwise(F.col("_before"))
    return u.select("step", "label", kind.alias("kind"), "value", bottom.alias("bottom"), top_.alias("top"))


def mix_table(deltas: DataFrame, p: Params) -> DataFrame:
    """Channels above the spend floor this week; share of their spend and
    the spend-weighted mean ROAS of the set."""
    d = deltas.where(F.col("spend_now") > p.mix_min_spend)
    tot = d.agg(F.sum("spend_now").alias("_s"), F.sum(F.col("spend_now") * F.col("roas_now")).alias("_sr"))
    d = with_scalar(d, tot)
    return d.select("channel", "label", F.col("spend_now").alias("spend"), F.col("roas_now").alias("roas"),
                    F.col("gmv_now").alias("gmv"), X.ratio0("spend_now", "_s").alias("spend_share"),
                    X.ratio0("_sr", "_s").alias("weighted_roas"))


def _status(ratio):
    lo, hi = S.PACING_BAND
    return F.when(ratio < lo, "behind").when(ratio > hi, "over").otherwise("on")


def _month_rows(scan: DataFrame, p: Params) -> DataFrame:
    start = F.trunc(F.lit(p.as_of), "month")
    return market_filter(scan.where((F.col("date_local") >= start) & (F.col("date_local") <= F.lit(p.as_of))),
                         p.market)


def _month_days(p: Params) -> int:
    import calendar
    return 30 if p.compat else calendar.monthrange(p.as_of.year, p.as_of.month)[1]


def pacing(scan: DataFrame, p: Params, budgets: DataFrame | None = None) -> DataFrame:
    """R8 + R9: month-to-date actuals, linear forecast to month end, plan from
    ``budgets`` (metric, plan) when given (a metric without one has plan 0),
    else forecast x plan multiplier; dial status.

    D16: the month length is the real one (``compat``: 30 days)."""
    dom = p.as_of.day
    md = _month_days(p)
    k = kpis(_month_rows(scan, p))

    def proj(c):
        return F.col(c) * md / dom if dom > 0 else F.col(c)
    m = p.plan_mult
    rows = [("gmv", F.col("gmv"), proj("gmv"), m["gmv"]), ("spend", F.col("spend"), proj("spend"), m["spend"]),
            ("orders", F.col("orders").cast("double"), proj("orders"), m["orders"]),
            ("roas", F.col("roas"), F.col("roas"), m["roas"])]
    parts = [k.select(F.lit(name).alias("metric"), a.alias("actual"), f.alias("forecast"),
                      (f * mult).alias("plan")) for name, a, f, mult in rows]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    if budgets is not None:
        u = u.drop("plan").join(F.broadcast(budgets.groupBy("metric").agg(F.sum("plan").alias("plan"))), "metric", "left") \
             .withColumn("plan", F.coalesce("plan", F.lit(0.0)))  # four metrics
    ratio = F.when(F.col("plan") > 0, F.col("forecast") / F.col("plan")).otherwise(F.lit(0.0))
    return u.select("metric", "actual", "plan", "forecast", F.lit(dom).alias("day_of_month"),
                    F.lit(md - dom).alias("days_left"), ratio.alias("pace_ratio"), _status(ratio).alias("status"))


def channel_plan_mult(channel) -> F.Column:
    """Demo per-channel plan factor of the reference dashboard (fixed rule:
    0.85 + (len(channel id) % 5) * 0.07), used until budgets are supplied."""
    return F.lit(S.CHANNEL_PLAN_BASE) + (F.length(channel) % S.CHANNEL_PLAN_MOD) * F.lit(S.CHANNEL_PLAN_STEP)


def channel_pacing(scan: DataFrame, taxonomy: DataFrame, p: Params, budgets: DataFrame | None = None) -> DataFrame:
    """R8/R9 per paid channel: MTD spend, forecast, plan (from ``budgets``
    (channel, plan) when given), status with the denominator max(plan, 1)."""
    dom, md = p.as_of.day, _month_days(p)
    s = _month_rows(scan, p).groupBy("channel").agg(F.sum("spend_usd").alias("actual"))
    t = taxonomy.where(F.col("group") != "organic").select("channel", "label", "tax_order")
    d = t.join(s, "channel", "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    d = d.withColumn("forecast", F.col("actual") * md / dom if dom > 0 else F.col("actual"))
    if budgets is not None:
        d = d.join(F.broadcast(budgets.select("channel", F.col("plan").alias("_plan"))), "channel", "left") \
             .withColumn("plan", F.coalesce("_plan", F.lit(0.0))).drop("_plan")
    else:
        d = d.withColumn("plan", F.col("forecast") * channel_plan_mult(F.col("channel")))
    ratio = F.col("forecast") / F.greatest(F.col("plan"), F.lit(1.0))
    return d.select("channel", "label", "actual", "plan", "forecast", ratio.alias("pace_ratio"),
                    _status(ratio).alias("status"))


SHOPEE_AD_ORDER = ["shopee_ads_gmv_max", "shopee_ads_product_search", "shopee_ads_targeting",
                   "shopee_ads_shop_search", "shopee_ads_affiliate"]


def reallocation(deltas: DataFrame, p: Params) -> DataFrame:
    """Three pinned budget moves.

    1. google_ads_shopee: cut 15% when its ROAS shift is below -8%, else scale.
    2. the Shopee ads sub-channel with the most spend: cut 20% when its shift
       is below -5%, else scale 12%.
    3. shift 10% of min(spend) from meta_cpas to the unpinned channel with the
       best ROAS (spend above the floor, prior ROAS > 0).
    Impact: cut -round($ x ROAS x 0.4); scale round($ x ROAS); shift
    max(round($ x (ROAS_to - ROAS_from)), 0); rounding is half up (floor(x+.5)).
    """
    d = deltas
    g = d.where(F.col("channel") == "google_ads_shopee")
    g_trig, g_cut, g_scale = S.REALLOC_GOOGLE
    s_trig, s_cut, s_scale = S.REALLOC_SHOPEE_ADS
    k = S.REALLOC_TRIM_IMPACT
    trim1 = F.col("roas_shift_pct") < g_trig
    dol1 = X.js_round(F.col("spend_now") * F.when(trim1, g_cut).otherwise(g_scale))
    r1 = g.select(
        F.lit(1).alias("rule"), F.when(trim1, "cut").otherwise("scale").alias("action"),
        F.when(trim1, F.col("channel")).alias("from_channel"),
        F.when(~trim1, F.col("channel")).alias("to_channel"),
        dol1.cast("double").alias("dollars"),
        F.when(trim1, -X.js_round(dol1 * (F.col("roas_now") * k)))
         .otherwise(X.js_round(dol1 * F.col("roas_now"))).cast("double").alias("impact"),
        F.lit("high").alias("conviction"))
    order = F.array_position(F.array(*[F.lit(c) for c in SHOPEE_AD_ORDER]), F.col("channel"))
    sh = d.where(F.col("channel").isin(*SHOPEE_AD_ORDER)) \
          .withColumn("_r", F.row_number().over(Window.orderBy(F.col("spend_now").desc(), order))) \
          .where("_r = 1")
    trim2 = F.col("roas_shift_pct") < s_trig
    dol2 = X.js_round(F.col("spend_now") * F.when(trim2, s_cut).otherwise(s_scale))
    r2 = sh.select(
        F.lit(2).alias("rule"), F.when(trim2, "cut").otherwise("scale").alias("action"),
        F.when(trim2, F.col("channel")).alias("from_channel"),
        F.when(~trim2, F.col("channel")).alias("to_channel"),
        dol2.cast("double").alias("dollars"),
        F.when(trim2, -X.js_round(dol2 * (F.col("roas_now") * k)))
         .otherwise(X.js_round(dol2 * F.col("roas_now"))).cast("double").alias("impact"),
        F.lit("medium").alias("conviction"))
    pinned = sh.select(F.col("channel").alias("_pin")).unionByName(
        F.broadcast(d.sparkSession.createDataFrame([("google_ads_shopee",), ("meta_cpas",)], "_pin string")))
    cand = d.join(F.broadcast(pinned), d.channel == F.col("_pin"), "left_anti") \
            .where((F.col("spend_now") > p.partner_min_spend) & (F.col("roas_prev") > 0))
    partner = cand.withColumn("_r", F.row_number().over(
        Window.orderBy(F.col("roas_now").desc(), F.col("spend_now").desc(), "tax_order"))).where("_r = 1")
    meta = d.where(F.col("channel") == "meta_cpas").select(
        F.col("spend_now").alias("m_spend"), F.col("roas_now").alias("m_roas"))
    pm = with_scalar(partner, meta)
    dol3 = X.js_round(F.least("m_spend", "spend_now") * S.REALLOC_SHIFT_SHARE)
    r3 = pm.select(
        F.lit(3).alias("rule"), F.lit("shift").alias("action"), F.lit("meta_cpas").alias("from_channel"),
        F.col("channel").alias("to_channel"), dol3.cast("double").alias("dollars"),
        F.greatest(X.js_round(dol3 * (F.col("roas_now") - F.col("m_roas"))), F.lit(0)).cast("double").alias("impact"),
        F.lit("medium").alias("conviction"))
    return r1.unionByName(r2).unionByName(r3)
