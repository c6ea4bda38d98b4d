"""Media-response operators on any panel: adstock, saturation, seasonality,
GMV cap, allocation, voucher share, attribution split, what-if patches,
ROAS bands, modelled engaged-view conversions, expected funnel, cross rates.

M1-M12, W6, J13, J14, PF18.

Series operators partition by (market, channel): a series holds one row per
day, so its size is bounded by the calendar whatever the order volume.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import seeds

PAID = seeds.PAID_CHANNELS


def _paid_series(panel: DataFrame) -> DataFrame:
    """(market, channel, date, spend) of paid channels, densified to one row
    per day between each series' first and last date (missing days = 0).

    The day spine is an ``explode(sequence(min, max))`` per series: bounded by
    the calendar, no cross join."""
    p = panel.where(F.col("channel").isin(*PAID)).groupBy("market", "channel", "date_local") \
             .agg(F.sum("spend_usd").alias("spend"))
    spine = p.groupBy("market", "channel").agg(F.min("date_local").alias("_lo"), F.max("date_local").alias("_hi")) \
             .select("market", "channel", F.explode(F.sequence("_lo", "_hi")).alias("date_local"))
    return spine.join(p, ["market", "channel", "date_local"], "left") \
                .withColumn("spend", F.coalesce("spend", F.lit(0.0)))


def adstock(panel: DataFrame, priors: DataFrame) -> DataFrame:
    """Geometric adstock a[t] = s[t] + 0.5^(1/h) a[t-1] per (market,
    channel); h <= 0, or no prior, passes spend through.

    The recursion is a prefix scan over blocks of ``BLOCK_DAYS`` days
    (``decayed_sums``): linear in the days, with no array per series, and exact
    for any half-life.
    """
    pr = priors.select("channel", F.when(F.col("halflife") > 0, F.pow(F.lit(0.5), 1.0 / F.col("halflife")))
                       .otherwise(F.lit(0.0)).alias("decay"))
    s = _paid_series(panel).join(F.broadcast(pr), "channel", "left").withColumn("decay", F.coalesce("decay", F.lit(0.0)))
    s = s.withColumn("_at", F.datediff("date_local", F.lit(SCAN_ORIGIN).cast("date")).cast("long"))
    out = decayed_sums(s, ["market", "channel"], "_at", "decay", "spend", "adstock")
    return out.select("market", "channel", "date_local", "spend", "decay", "adstock")


BLOCK_DAYS = 64
SCAN_LEVELS = 2            # of blocks of blocks: 64 ** 3 days, 717 years
SCAN_ORIGIN = "1900-01-01"  # days before it are not carried on


def decayed_sums(df: DataFrame, keys: list[str], at: str, decay: str, value: str, name: str,
                 levels: int = SCAN_LEVELS) -> DataFrame:
    """``df`` plus ``name`` = value + decay x the ``name`` of the step before, per
    key over consecutive integers ``at`` from 0 to ``BLOCK_DAYS ** (levels + 1)``,
    as an associative prefix scan.

    Inside a block each value is carried on by windows of the block alone:
    ``log2(BLOCK_DAYS)`` doubling steps, the k-th adding the sums that end 2^k
    steps earlier, decayed over that many steps. What a block hands on is its
    last sum; these are scanned the same way with the decay of a whole block, one
    row per block, and added to the rows behind it."""
    block = [*keys, "_block"]
    x = df.withColumn("_block", F.floor(F.col(at) / BLOCK_DAYS)).withColumn(name, F.col(value))
    order = Window.partitionBy(*block).orderBy(at)
    step = 1
    while step < BLOCK_DAYS:
        before = F.coalesce(F.lag(name, step).over(order), F.lit(0.0))
        x = x.withColumn(name, F.col(name) + F.pow(decay, F.lit(float(step))) * before)
        step *= 2
    if levels == 0:
        return x.drop("_block")
    end, far, total = f"_end{levels}", f"_far{levels}", f"_sum{levels}"
    ends = x.groupBy(*block).agg(F.max_by(name, at).alias(end), F.max(F.pow(decay, F.lit(float(BLOCK_DAYS)))).alias(far))
    carried = decayed_sums(ends.withColumnRenamed("_block", f"_step{levels}"), keys, f"_step{levels}", far, end, total, levels - 1)
    x = x.join(carried.select(*keys, (F.col(f"_step{levels}") + 1).alias("_block"), total), block, "left")
    into = F.col(at) - F.col("_block") * BLOCK_DAYS + 1
    return x.withColumn(name, F.col(name) + F.coalesce(F.col(total), F.lit(0.0)) * F.pow(decay, into.cast("double"))) \
            .drop("_block", total)


def hill(x: Column, ec50: Column, shape: Column) -> Column:
    """M2: x^s / (x^s + ec50^s) with x clipped at 0 (ec50 > 0)."""
    xs = F.pow(F.greatest(x, F.lit(0.0)), shape)
    return xs / (xs + F.pow(ec50, shape))


def hill_response(panel: DataFrame, priors: DataFrame) -> DataFrame:
    """M3: calibrated response: adstock -> Hill with ec50 = baseline / (1 -
    decay) (the steady-state adstock of the baseline spend) -> scaled by the
    asymptote 2 x ROAS x baseline."""
    a = adstock(panel, priors)
    pr = priors.select("channel", "hill_shape", "baseline_roas", "daily_spend")
    a = a.join(F.broadcast(pr), "channel")
    ec50 = F.col("daily_spend") / F.greatest(F.lit(1e-9), F.lit(1.0) - F.col("decay"))
    sat = hill(F.col("adstock"), ec50, F.col("hill_shape"))
    return a.select("market", "channel", "date_local", "spend", "adstock", sat.alias("saturation"),
                    (sat * 2.0 * F.col("baseline_roas") * F.col("daily_spend")).alias("response"))


DOW_ORDER = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]  # Spark dayofweek 1..7


def seasonality_multiplier(days: DataFrame, events: DataFrame, dow=None, payday_days=None,
                           payday_uplift: float | None = None) -> DataFrame:
    """M4 + J13: day-of-week x payday x product of the uplifts of events active
    that day in that market, per (market, date), and per (market, channel,
    date) when ``days`` has a channel. NULL or empty ``markets`` or
    ``channels`` of an event mean all of them (D20); an event bound to
    channels leaves a frame without channels alone.

    The interval join is an equi-join: event windows are exploded to days
    (bounded by the calendar) and joined on the date and whichever of market
    and channel the event names."""
    dow = dict(seeds.DOW_MULTIPLIER if dow is None else dow)
    payday_days = seeds.PAYDAY_DAYS if payday_days is None else payday_days
    payday_uplift = seeds.PAYDAY_UPLIFT if payday_uplift is None else payday_uplift
    by_channel = "channel" in days.columns
    keys = ["market", "channel", "date_local"] if by_channel else ["market", "date_local"]
    ev = events if "channels" in events.columns else events.withColumn("channels", F.lit(None).cast("array<string>"))
    ev = (ev.withColumn("date_local", F.explode(F.sequence("start", "end")))
            .withColumn("markets", F.when(F.size("markets") > 0, F.col("markets")))
            .withColumn("channels", F.when(F.size("channels") > 0, F.col("channels"))))
    d = days.select(*keys).distinct()
    mult = F.lit(1.0)
    for on_market in (False, True):
        for on_channel in (False, True) if by_channel else (False,):
            e = ev.where(F.col("markets").isNotNull() if on_market else F.col("markets").isNull())
            e = e.where(F.col("channels").isNotNull() if on_channel else F.col("channels").isNull())
            on = ["date_local"]
            if on_market:
                e, on = e.withColumn("market", F.explode("markets")), on + ["market"]
            if on_channel:
                e, on = e.withColumn("channel", F.explode("channels")), on + ["channel"]
            name = f"_m{int(on_market)}{int(on_channel)}"
            e = e.groupBy(*on).agg(F.product("uplift_mult").alias(name))
            # Bounded by calendar days x markets x channels.
            d = d.join(F.broadcast(e), on, "left")
            mult = mult * F.coalesce(F.col(name), F.lit(1.0))
    dow_arr = F.array(*[F.lit(float(dow.get(n, 1.0))) for n in DOW_ORDER])
    base = F.element_at(dow_arr, F.dayofweek("date_local")) * \
        F.when(F.dayofmonth("date_local").isin(*payday_days), F.lit(payday_uplift)).otherwise(F.lit(1.0))
    return d.select(*keys, F.element_at(dow_arr, F.dayofweek("date_local")).alias("dow_mult"),
                    mult.alias("event_mult"), (base * mult).alias("multiplier"))


def gmv_cap(panel: DataFrame, share: float = seeds.GMV_CAP_SHARE) -> DataFrame:
    """M5 + J14: per (date, market, anchor platform) scale attributed GMV so
    its sum stays within ``share`` of the platform total; organic GMV = total
    - capped ads. One window sum instead of aggregate + join back."""
    ads = panel.where(F.col("ads_attributed_gmv_usd").isNotNull())
    g = Window.partitionBy("date_local", "market", "platform")
    ads = ads.withColumn("ads_total", F.sum("ads_attributed_gmv_usd").over(g))
    allowed = F.col("platform_total_gmv_usd") * share
    clip = F.when(F.col("ads_total") > allowed, allowed / F.col("ads_total")).otherwise(F.lit(1.0))
    clip = F.coalesce(F.when(F.col("ads_total") != 0, clip), F.lit(1.0))
    ads = ads.withColumn("clip_factor", clip)
    return ads.select("date_local", "market", "channel", "platform", "ads_attributed_gmv_usd", "ads_total",
                      "platform_total_gmv_usd", "clip_factor",
                      (F.col("ads_attributed_gmv_usd") * F.col("clip_factor")).alias("capped_gmv_usd"),
                      (F.col("platform_total_gmv_usd") - F.col("ads_total") * F.col("clip_factor"))
                      .alias("organic_gmv_usd"))


def allocate(df: DataFrame, weights: DataFrame, key: list[str], amounts: list[str], counts: list[str],
             slot: str, normalize: bool = True) -> DataFrame:
    """M6: split totals over weighted slots: amount x w / sum(w); counts are
    rounded half to even (``bround``). ``weights`` = key columns + slot + w.
    ``normalize=False`` takes ``w`` as final shares."""
    share = F.col("w") / F.sum("w").over(Window.partitionBy(*key)) if normalize else F.col("w")
    w = weights.withColumn("_share", share)
    j = df.join(w, key)
    return j.select(*[c for c in df.columns if c not in amounts + counts], slot, "_share",
                    *[(F.col(a) * F.col("_share")).alias(a) for a in amounts],
                    *[F.bround(F.col(c) * F.col("_share"), 0).cast("long").alias(c) for c in counts])


def allocation_shares() -> list[tuple[str, str, str, float]]:
    """Shares of the three families (family, channel, slot, share): Google
    campaign types, Shopee ad types, and the traffic sources of a platform."""
    rows = [("campaign_type", "google_ads_shopee", t, w) for t, w in seeds.GOOGLE_CAMPAIGN_TYPE_WEIGHTS]
    rows += [("ad_type", "shopee_ads", t, w) for t, w in seeds.SHOPEE_AD_TYPE_WEIGHTS]
    rows += [("traffic_source", p, t, w) for p, t, w in seeds.TRAFFIC_SOURCE_WEIGHTS]
    total = {k: math.fsum(w for f, c, _, w in rows if (f, c) == k) for k in {r[:2] for r in rows}}
    return [(f, c, t, w / total[f, c]) for f, c, t, w in rows]


def allocation_weights(spark) -> DataFrame:
    return spark.createDataFrame(allocation_shares(), "family string, channel string, slot string, w double")


def voucher_share(panel: DataFrame, priors: DataFrame, mult: DataFrame) -> DataFrame:
    """M7: voucher-funded share of spend per Shopee ads row:
    base x (0.7 + 0.3 x m / mean(m over the series)) x (1.3 when m > 1.8),
    clipped to [0, 0.45]."""
    pr = priors.where(F.col("voucher_pct") > 0).select("channel", "voucher_pct")
    s = panel.join(F.broadcast(pr), "channel").join(mult.select("market", "date_local", "multiplier"),
                                                   ["market", "date_local"], "left")
    m = F.coalesce(F.col("multiplier"), F.lit(1.0))
    s = s.withColumn("_m", m).withColumn("_mean", F.avg("_m").over(Window.partitionBy("market", "channel")))
    pct = F.col("voucher_pct") * (F.lit(seeds.VOUCHER_BASE) + seeds.VOUCHER_SLOPE * F.col("_m") / F.col("_mean")) * \
        F.when(F.col("_m") > seeds.VOUCHER_PEAK_MULT, F.lit(seeds.VOUCHER_PEAK_BOOST)).otherwise(F.lit(1.0))
    pct = F.least(F.greatest(pct, F.lit(0.0)), F.lit(seeds.VOUCHER_MAX))
    return s.select("date_local", "market", "channel", F.col("_m").alias("multiplier"), pct.alias("voucher_pct"),
                    (F.col("spend_usd") * pct).alias("voucher_usd"))


def attribution_split(panel_evc: DataFrame) -> DataFrame:
    """M8: split each channel-day's click and engaged-view conversions into
    the platforms' report rows with fixed weights; zero rows are dropped.

    Google: per campaign type, click x w_click (click-through) and evc x w_evc
    (engaged view, value x 0.6); Meta: int(click x 0.8) 7d_click,
    int(click x 0.2) 1d_click, evc 1d_ev; TikTok: int(click x 0.95) CTA, the
    rest VTA, evc EVTA."""
    spark = panel_evc.sparkSession
    base = panel_evc.select(
        "date_local", "market", "channel",
        F.greatest(F.col("all_conversions") - F.col("evc_conversions"), F.lit(0.0)).alias("click_conv"),
        F.col("evc_conversions").alias("evc_conv"),
        F.coalesce("ads_attributed_gmv_usd", F.lit(0.0)).alias("value"))
    gw = spark.createDataFrame([("google_ads_shopee", t, c, e) for t, c, e in seeds.GOOGLE_EVC_SPLITS],
                               "channel string, campaign_type string, w_click double, w_evc double")
    g = base.join(F.broadcast(gw), "channel")
    ct, ev = F.col("click_conv") * F.col("w_click"), F.col("evc_conv") * F.col("w_evc")
    g1 = g.where(ct + ev != 0).select("date_local", "market", "channel", "campaign_type",
                                      F.lit("click_through").alias("kind"), ct.alias("conversions"),
                                      (F.col("value") * F.col("w_click")).alias("value_usd"))
    g2 = g.where((ct + ev != 0) & (ev > 0)).select("date_local", "market", "channel", "campaign_type",
                                                   F.lit("engaged_view").alias("kind"), ev.alias("conversions"),
                                                   (F.col("value") * F.col("w_evc") * 0.6).alias("value_usd"))
    meta = base.where(F.col("channel") == "meta_cpas")
    m_rows = [("7d_click", F.floor(F.col("click_conv") * 0.8), 0.8),
              ("1d_click", F.floor(F.col("click_conv") * 0.2), 0.2),
              ("1d_ev", F.floor(F.col("evc_conv")), 0.25)]
    tt = base.where(F.col("channel") == "tiktok_ads")
    cta = F.floor(F.col("click_conv") * 0.95)
    t_rows = [("CTA", cta, 0.80), ("VTA", F.greatest(F.floor(F.col("click_conv")) - cta, F.lit(0)), 0.05),
              ("EVTA", F.floor(F.col("evc_conv")), 0.15)]
    parts = [g1, g2]
    for src, rows in ((meta, m_rows), (tt, t_rows)):
        for kind, cnt, vs in rows:
            parts.append(src.where(cnt != 0).select(
                "date_local", "market", "channel", F.lit(None).cast("string").alias("campaign_type"),
                F.lit(kind).alias("kind"), cnt.cast("double").alias("conversions"),
                (F.col("value") * vs).alias("value_usd")))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    return u


WHAT_IF_METRICS = ["spend_usd", "impressions", "clicks", "ads_orders", "ads_gmv_usd", "platform_total_gmv_usd"]


def scenario_patches(spark, name: str) -> DataFrame:
    if name not in seeds.SCENARIOS:
        raise KeyError(f"unknown scenario: {name} (available: {sorted(seeds.SCENARIOS)})")
    return spark.createDataFrame([(i, *x) for i, x in enumerate(seeds.SCENARIOS[name])],
                                 "seq long, channel string, metric string, op string, value double")


WHAT_IF_OPS = ("set", "mul", "add")


def what_if(rows: DataFrame, patches: DataFrame, metrics=None) -> DataFrame:
    """M9: apply (channel, metric, op, value) patches to panel rows, in their
    order: by ``seq`` when the patch table has it, else as listed (several
    patches on one metric build on each other). An unknown op, metric or
    channel (one that no row has) fails the query.

    Patches of a channel travel as one ordered array per row of that channel;
    each metric folds those that name it. The join is a full outer one, so a
    patch without rows is seen; unknown names raise in the plan."""
    metrics = list(metrics or WHAT_IF_METRICS)
    p = patches if "seq" in patches.columns else patches.withColumn("seq", F.monotonically_increasing_id())
    # A missing value counts as an unknown op: nothing could be applied.
    known = F.col("op").isin(*WHAT_IF_OPS) & F.col("metric").isin(*metrics) & F.col("value").isNotNull()
    bad = F.raise_error(F.concat(F.lit("what-if: unknown op or metric: "), F.coalesce("op", F.lit("null")), F.lit(" "),
                                 F.coalesce("metric", F.lit("null")), F.lit(" of "), F.coalesce("channel", F.lit("null"))))
    p = p.withColumn("metric", F.when(F.coalesce(known, F.lit(False)), F.col("metric")).otherwise(bad))
    by_channel = p.groupBy("channel").agg(
        F.sort_array(F.collect_list(F.struct("seq", "metric", "op", F.col("value").cast("double").alias("value")))).alias("_p"))
    src = rows.withColumn("_here", F.lit(True))
    out = src.join(by_channel.withColumnRenamed("channel", "_ch"), F.col("channel") == F.col("_ch"), "full_outer")

    def patched(m):
        def step(acc, x):
            return (F.when(x["op"] == "set", x["value"]).when(x["op"] == "mul", acc * x["value"])
                    .otherwise(acc + x["value"]))
        own = F.filter(F.coalesce("_p", F.array().cast(by_channel.schema["_p"].dataType)), lambda x: x["metric"] == m)
        return F.when(F.col("_p").isNull(), F.col(m)).otherwise(F.aggregate(own, F.col(m).cast("double"), step)).alias(m)
    lost = F.raise_error(F.concat(F.lit("what-if: no row of channel "), F.col("_ch")))
    channel = F.when(F.col("_here"), F.col("channel")).otherwise(lost).alias("channel")
    return out.select(*[channel if c == "channel" else patched(c) if c in metrics else F.col(c) for c in rows.columns])


def roas_bands(panel: DataFrame, priors: DataFrame, tolerance: float = seeds.ROAS_BAND_TOLERANCE) -> DataFrame:
    """Aggregate ROAS per paid channel against its prior band widened by
    +-``tolerance``; ``in_band`` false marks a violation."""
    a = panel.where(F.col("channel").isin(*PAID)).groupBy("channel").agg(
        F.sum("spend_usd").alias("spend"), F.sum(F.coalesce("ads_attributed_gmv_usd", F.lit(0.0))).alias("gmv"))
    a = a.join(F.broadcast(priors.select("channel", "roas_lo", "roas_hi")), "channel")
    roas = F.when(F.col("spend") > 0, F.col("gmv") / F.col("spend")).otherwise(F.lit(0.0))
    lo, hi = F.col("roas_lo") * (1 - tolerance), F.col("roas_hi") * (1 + tolerance)
    return a.select("channel", roas.alias("roas"), lo.alias("band_lo"), hi.alias("band_hi"),
                    ((roas >= lo) & (roas <= hi)).alias("in_band"))


def modelled_evc(panel: DataFrame, priors: DataFrame) -> DataFrame:
    """Expected all / engaged-view conversions from a coverage rate:
    all = bround(orders / (1 - coverage)) (half to even, as numpy), evc =
    coverage share of all, bounded to [0, all]; no coverage -> all = orders,
    evc = 0."""
    p = panel.where(F.col("channel").isin(*PAID)).join(
        F.broadcast(priors.select("channel", "evc_coverage")), "channel", "left")
    orders = F.coalesce("ads_attributed_orders", F.lit(0)).cast("double")
    cov = F.col("evc_coverage")
    all_c = F.when(cov.isNull(), orders).otherwise(F.bround(orders / F.greatest(F.lit(1e-6), 1 - cov), 0))
    evc = F.when(cov.isNull(), F.lit(0.0)).otherwise(F.least(F.greatest(all_c * cov, F.lit(0.0)), all_c))
    return p.select("date_local", "market", "channel", orders.alias("orders"), all_c.alias("all_conversions"),
                    evc.alias("evc_conversions"))


def expected_funnel(panel: DataFrame, priors: DataFrame) -> DataFrame:
    """impressions = spend / cpm x 1000, clicks = impressions x ctr,
    orders = clicks x cvr, each clamped to the stage above."""
    p = panel.where(F.col("channel").isin(*PAID)).join(
        F.broadcast(priors.select("channel", "cpm", "ctr", "cvr")), "channel")
    impr = F.when(F.col("cpm") > 0, F.col("spend_usd") / F.col("cpm") * 1000.0).otherwise(F.lit(0.0))
    p = p.withColumn("exp_impressions", impr)
    p = p.withColumn("exp_clicks", F.least(F.col("exp_impressions") * F.col("ctr"), F.col("exp_impressions")))
    p = p.withColumn("exp_orders", F.least(F.col("exp_clicks") * F.col("cvr"), F.col("exp_clicks")))
    return p.select("date_local", "market", "channel", "spend_usd", "exp_impressions", "exp_clicks", "exp_orders")


def cross_rate(df: DataFrame, amount: str, market_col: str, date_col: str, to_currency: str,
               dim_market: DataFrame, fx: DataFrame) -> DataFrame:
    """PF18: amount x rate(to) / rate(from) on the row's date; a market
    outside the dimension converts at 1.0; a missing rate gives NULL."""
    dm = dim_market.select(F.col("market").alias("_m"), F.col("currency").alias("_from_cur"))
    f1 = fx.select(F.col("date").alias("_d1"), F.col("currency").alias("_c1"), F.col("usd_rate").alias("_r_from"))
    f2 = fx.where(F.col("currency") == to_currency).select(F.col("date").alias("_d2"), F.col("usd_rate").alias("_r_to"))
    j = df.join(F.broadcast(dm), F.col(market_col) == F.col("_m"), "left")
    j = j.join(F.broadcast(f1), (F.col(date_col) == F.col("_d1")) & (F.col("_from_cur") == F.col("_c1")), "left")
    j = j.join(F.broadcast(f2), F.col(date_col) == F.col("_d2"), "left")
    factor = F.when(F.col("_m").isNull(), F.lit(1.0)).otherwise(
        F.try_divide(F.col("_r_to").cast("double"), F.col("_r_from").cast("double")))
    out = j.withColumn(f"{amount}_{to_currency.lower()}", F.col(amount).cast("double") * factor)
    return out.drop("_m", "_from_cur", "_d1", "_c1", "_r_from", "_d2", "_r_to")
