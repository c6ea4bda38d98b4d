"""Analytics on the daily channel panel: scan, KPIs, weekly story, deltas,
anomaly levels, daily report and channel brief metrics.

IO10, IO11, PF13-PF15, A12-A19, W4, W7-W9, T1-T4, R1-R4, R11.

Every operator here reads the panel, whose size is bounded by days x markets x
channels regardless of the order volume behind it. Frames that are global by
nature (the distinct dates of the window, the channel list) are bounded by
the calendar or the taxonomy, so ordering them without a partition key moves
at most a few hundred rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from ..sources import seeds as S
from ..sources.seeds import MARKET_CODES, PAID_CHANNELS


# ------------------------------------------------------------------ scan
def scan_reach(p: Params) -> int:
    """Days before as_of that the scan has to hold."""
    return max(p.scan_days, 2 * p.range_days)


def scan_panel(panel: DataFrame, taxonomy: DataFrame, p: Params) -> DataFrame:
    """IO10 + PF14 + PF15: the slice [as_of - scan_days, as_of] of the panel (or
    its EVC variant), reaching back two filter windows where that is longer
    (W7 compares them); NULL measures as 0, taxonomy labels joined on.

    Partition pruning on ``date_local`` applies when the panel is a table
    partitioned by it.
    """
    d = F.col("date_local")
    rows = panel.where(d.between(F.date_sub(F.lit(p.as_of), scan_reach(p)), F.lit(p.as_of)))
    has_evc = "evc_gmv_usd" in panel.columns
    evc_gmv = F.coalesce(F.col("evc_gmv_usd"), F.lit(0.0)) if has_evc else F.lit(0.0)
    evc_conv = F.coalesce(F.col("evc_conversions"), F.lit(0.0)) if has_evc else F.lit(0.0)
    ads_gmv = F.coalesce(F.col("ads_attributed_gmv_usd"), F.lit(0.0))
    ads_orders = F.coalesce(F.col("ads_attributed_orders"), F.lit(0)).cast("double")
    if p.evc:
        ads_gmv, ads_orders = ads_gmv + evc_gmv, ads_orders + evc_conv
    rows = rows.select(
        "date_local", "market", "channel", "platform", "spend_usd",
        F.coalesce("impressions", F.lit(0)).alias("impressions"),
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        ads_orders.alias("ads_orders"), ads_gmv.alias("ads_gmv_usd"),
        "direct_gmv_usd", "broad_gmv_usd", "platform_total_gmv_usd", "platform_total_orders",
        "is_weekend", "is_payday", F.coalesce("is_mega_sale", F.lit(False)).alias("is_mega_sale"),
        evc_conv.alias("evc_conversions"), evc_gmv.alias("evc_gmv_usd"))
    t = taxonomy.select("channel", "label", F.col("platform").alias("_tax_platform"),
                        F.col("group").alias("_group"), "priority", "tax_order")
    rows = rows.join(F.broadcast(t), "channel", "left")
    return rows.select(
        "date_local", "market", "channel",
        F.coalesce("label", "channel").alias("label"),
        F.coalesce("platform", "_tax_platform", F.lit("shopee")).alias("platform"),
        F.coalesce("_group", F.lit("on_platform")).alias("group"),
        F.coalesce("priority", F.lit(99)).alias("priority"),
        F.coalesce("tax_order", F.lit(99)).alias("tax_order"),
        *[c for c in rows.columns if c not in {"date_local", "market", "channel", "label", "platform",
                                                "_tax_platform", "_group", "priority", "tax_order"}])


def market_filter(rows: DataFrame, market: str) -> DataFrame:
    return rows if market == "all" else rows.where(F.col("market") == market)


def filter_range(rows: DataFrame, p: Params) -> DataFrame:
    """PF13: the last N calendar days ending at as_of (mtd = 20 days)."""
    cutoff = F.date_sub(F.lit(p.as_of), p.range_days - 1)
    return market_filter(rows.where(F.col("date_local") >= cutoff), p.market)


def last_dates(rows: DataFrame, n: int, label: bool = False) -> DataFrame:
    """The last ``n`` distinct dates present, ranked 1 = latest."""
    w = Window.orderBy(F.col("date_local").desc())
    d = rows.select("date_local").distinct().withColumn("date_rank", F.row_number().over(w))
    return d.where(F.col("date_rank") <= n)


def week_split(rows: DataFrame) -> DataFrame:
    """Label rows of the last 7 distinct dates 'now' and of the 7 before
    'prev'; no rows at all when fewer than 14 distinct dates exist."""
    d = last_dates(rows, 14)
    w_all = Window.partitionBy(F.lit(1))
    d = d.withColumn("_n", F.count(F.lit(1)).over(w_all)).where(F.col("_n") >= 14)
    d = d.select("date_local", F.when(F.col("date_rank") <= 7, "now").otherwise("prev").alias("wk"))
    return rows.join(F.broadcast(d), "date_local")


# ------------------------------------------------------------------ KPIs
def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a frame of at most one row (a global aggregate or
    a flag) as uncorrelated scalar subqueries: each is evaluated once and used
    as a value, so no join (and no cross join) is planned. An empty
    ``scalar`` empties the result (EXISTS filter)."""
    out = df.where(scalar.select(F.lit(1)).exists())
    for c in scalar.columns:
        out = out.withColumn(c, scalar.select(c).scalar())
    return out


def story_flag(rows: DataFrame) -> DataFrame:
    """One row when ``rows`` is non-empty, none otherwise."""
    return rows.select(F.lit(True).alias("_story")).limit(1)


def kpis(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Spend, de-duplicated platform GMV / orders (each (date, market,
    platform) counted once), attributed GMV and blended ROAS (0 w/o spend).

    Two-level aggregation: totals repeat on every channel row of a
    (date, market, platform), so they are reduced with ``max`` first, never
    summed over channels.
    """
    by = list(by or [])
    l1 = rows.groupBy(*by, "date_local", "market", "platform").agg(
        F.sum("spend_usd").alias("spend"),
        F.sum("ads_gmv_usd").alias("ads_gmv"),
        F.max(F.coalesce("platform_total_gmv_usd", F.lit(0.0))).alias("gmv"),
        F.max(F.coalesce("platform_total_orders", F.lit(0))).alias("orders"))
    l2 = l1.groupBy(*by).agg(
        F.sum("spend").alias("spend"), F.sum("gmv").alias("gmv"),
        F.sum("orders").alias("orders"), F.sum("ads_gmv").alias("ads_gmv"))
    return l2.withColumn("roas", X.ratio0("ads_gmv", "spend"))


def _pivot_week(k: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    aggs = []
    for m in metrics:
        for wk in ("now", "prev"):
            aggs.append(F.sum(F.when(F.col("wk") == wk, F.col(m))).alias(f"{m}_{wk}"))
    g = k.groupBy(*keys) if keys else k.groupBy()
    return g.agg(*aggs)


def weekly_blended(rows: DataFrame, p: Params) -> DataFrame:
    """Blended KPIs of this vs prior week and their relative deltas."""
    r = week_split(market_filter(rows, p.market))
    k = _pivot_week(kpis(r, ["wk"]), [], ["spend", "gmv", "orders", "ads_gmv", "roas"])
    k = k.where(F.col("spend_now").isNotNull() | F.col("spend_prev").isNotNull())
    return k.select("*", *[X.pct_delta(f"{m}_now", f"{m}_prev").alias(f"{m}_delta")
                           for m in ("spend", "gmv", "roas", "orders")])


def paid_taxonomy(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.where(F.col("group") != "organic")


def channel_deltas(rows: DataFrame, taxonomy: DataFrame, p: Params) -> DataFrame:
    """R2: per paid channel, spend / attributed GMV / ROAS this vs prior week.
    Channels without rows are kept with zeros (taxonomy-driven)."""
    r = week_split(market_filter(rows, p.market))
    agg = r.groupBy("channel").agg(
        F.sum(F.when(F.col("wk") == "now", F.col("spend_usd"))).alias("spend_now"),
        F.sum(F.when(F.col("wk") == "prev", F.col("spend_usd"))).alias("spend_prev"),
        F.sum(F.when(F.col("wk") == "now", F.col("ads_gmv_usd"))).alias("gmv_now"),
        F.sum(F.when(F.col("wk") == "prev", F.col("ads_gmv_usd"))).alias("gmv_prev"))
    # An empty story (fewer than 14 dates) yields no rows at all.
    t = paid_taxonomy(taxonomy).select("channel", "label", "group", "platform", "priority", "tax_order")
    d = with_scalar(t, story_flag(r)).join(agg, "channel", "left")
    d = d.select("channel", "label", "group", "platform", "priority", "tax_order",
                 *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("spend_now", "spend_prev", "gmv_now", "gmv_prev")])
    d = d.withColumn("spend_delta", X.pct_delta("spend_now", "spend_prev")) \
         .withColumn("roas_now", X.ratio0("gmv_now", "spend_now")) \
         .withColumn("roas_prev", X.ratio0("gmv_prev", "spend_prev"))
    d = d.withColumn("roas_shift", F.col("roas_now") - F.col("roas_prev")) \
         .withColumn("roas_shift_pct", X.ratio0("roas_shift", "roas_prev"))
    return d


def market_deltas(rows: DataFrame, dim_market: DataFrame, p: Params) -> DataFrame:
    """Per market, GMV / spend / ROAS deltas week over week."""
    r = week_split(market_filter(rows, p.market))
    k = _pivot_week(kpis(r, ["wk", "market"]), ["market"], ["gmv", "spend", "roas"])
    m = with_scalar(dim_market.select("market", "country_name"), story_flag(r))
    d = m.join(k, "market", "left").select(
        "market", "country_name",
        *[F.coalesce(f"{x}_{w}", F.lit(0.0)).alias(f"{x}_{w}")
          for x in ("gmv", "spend", "roas") for w in ("now", "prev")])
    return d.select("market", "country_name", "gmv_now", "spend_now", "roas_now",
                    *[X.pct_delta(f"{x}_now", f"{x}_prev").alias(f"{x}_delta") for x in ("gmv", "spend", "roas")])


def top_movers(deltas: DataFrame, mkt: DataFrame, p: Params) -> DataFrame:
    """Among material channels (spend above the threshold in both weeks),
    the largest absolute spend delta and ROAS shift; the market leading GMV."""
    mat = deltas.where((F.col("spend_now") > p.material_spend) & (F.col("spend_prev") > p.material_spend)
                       & F.col("spend_delta").isNotNull())
    w1 = Window.orderBy(F.abs("spend_delta").desc(), "tax_order")
    w2 = Window.orderBy(F.abs("roas_shift").desc(), "tax_order")
    order = F.array_position(F.array(*[F.lit(m) for m in MARKET_CODES]), F.col("market"))
    w3 = Window.orderBy(F.col("gmv_now").desc(), order)
    a = mat.withColumn("_r", F.row_number().over(w1)).where("_r = 1").select(
        F.lit("top_mover").alias("kind"), F.col("channel").alias("id"), F.col("spend_delta").alias("value"))
    b = mat.withColumn("_r", F.row_number().over(w2)).where("_r = 1").select(
        F.lit("top_roas_shift").alias("kind"), F.col("channel").alias("id"), F.col("roas_shift").alias("value"))
    c = mkt.withColumn("_r", F.row_number().over(w3)).where("_r = 1").select(
        F.lit("lead_market").alias("kind"), F.col("market").alias("id"), F.col("gmv_now").alias("value"))
    return a.unionByName(b).unionByName(c)


def anomaly_level(deltas: DataFrame, p: Params) -> DataFrame:
    """First matching rule wins; a NULL spend delta counts as 0."""
    s = F.coalesce(F.col("spend_delta"), F.lit(0.0))
    r = F.coalesce(F.col("roas_shift_pct"), F.lit(0.0))
    lvl = (F.when((F.abs(r) > S.ANOMALY_ROAS_SWING) & (F.col("spend_now") > p.anomaly_spend_floor), "data_issue")
           .when(s < S.ANOMALY_SPEND_SLUMP, "slump").when(r < S.ANOMALY_ROAS_SLUMP, "slump")
           .when(s > S.ANOMALY_SPEND_SPIKE, "spike").otherwise("healthy"))
    return deltas.withColumn("level", lvl)


def watchlist(deltas: DataFrame, p: Params) -> DataFrame:
    """T4: first channels by spend with spend above the floor and a delta."""
    w = Window.orderBy(F.col("spend_now").desc(), "tax_order")
    d = deltas.withColumn("rank", F.row_number().over(w))
    d = d.where((F.col("spend_now") > p.watchlist_min_spend) & F.col("spend_delta").isNotNull())
    w2 = Window.orderBy("rank")
    return d.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= p.watchlist_size) \
            .select("rank", "channel", "spend_now", "spend_delta")


# ------------------------------------------------------------------ daily report
def daily_series(rows: DataFrame) -> DataFrame:
    """Per date, spend and de-duplicated platform GMV."""
    return kpis(rows, ["date_local"]).select("date_local", "spend", "gmv")


def channel_rollup(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Spend and attributed GMV per taxonomy channel, priority order,
    share of total spend."""
    agg = rows.groupBy("channel").agg(F.sum("spend_usd").alias("spend"), F.sum("ads_gmv_usd").alias("gmv"))
    tot = rows.agg(F.sum("spend_usd").alias("_tot"))
    t = taxonomy.select("channel", "label", "group", "priority")
    d = with_scalar(t.join(agg, "channel", "left"), tot)
    return d.select("channel", "label", "group", "priority",
                    F.coalesce("spend", F.lit(0.0)).alias("spend"), F.coalesce("gmv", F.lit(0.0)).alias("gmv"),
                    X.ratio0(F.coalesce("spend", F.lit(0.0)), "_tot").alias("spend_share"),
                    X.ratio0(F.coalesce("gmv", F.lit(0.0)), F.coalesce("spend", F.lit(0.0))).alias("roas"))


def share_divergence(rows: DataFrame, taxonomy: DataFrame, p: Params) -> DataFrame:
    """Share of spend vs share of attributed GMV for paid channels; the
    denominators include every channel; rows with both shares at or below the
    floor are dropped; divergence when |diff| exceeds the threshold."""
    agg = rows.groupBy("channel").agg(F.sum("spend_usd").alias("spend"), F.sum("ads_gmv_usd").alias("gmv"))
    tot = rows.agg(F.sum("spend_usd").alias("_ts"), F.sum("ads_gmv_usd").alias("_tg"))
    d = with_scalar(paid_taxonomy(taxonomy).select("channel", "priority").join(agg, "channel", "left"), tot)
    d = d.select("channel", "priority",
                 X.ratio0(F.coalesce("spend", F.lit(0.0)), "_ts").alias("spend_share"),
                 X.ratio0(F.coalesce("gmv", F.lit(0.0)), "_tg").alias("gmv_share"))
    d = d.where((F.col("spend_share") > p.share_floor) | (F.col("gmv_share") > p.share_floor))
    diff = F.col("spend_share") - F.col("gmv_share")
    return d.select("channel", "priority", "spend_share", "gmv_share", diff.alias("share_diff"),
                    (F.abs(diff) > p.divergence).alias("is_divergent"))


def attribution_roas(rows: DataFrame, taxonomy: DataFrame, levels: DataFrame) -> DataFrame:
    """A18 + R4: direct / broad / reported ROAS per paid channel with the
    anomaly level of the weekly story ('healthy' when there is none)."""
    agg = rows.groupBy("channel").agg(
        F.sum("spend_usd").alias("spend"),
        F.sum(F.coalesce("direct_gmv_usd", F.lit(0.0))).alias("direct"),
        F.sum(F.coalesce("broad_gmv_usd", F.lit(0.0))).alias("broad"),
        F.sum("ads_gmv_usd").alias("ads"))
    d = paid_taxonomy(taxonomy).select("channel", "platform", "priority").join(agg, "channel", "left")
    d = d.join(levels.select("channel", "level"), "channel", "left")
    sp = F.coalesce("spend", F.lit(0.0))
    return d.select("channel", "platform", "priority", sp.alias("spend"),
                    X.ratio0(F.coalesce("direct", F.lit(0.0)), sp).alias("direct_roas"),
                    X.ratio0(F.coalesce("broad", F.lit(0.0)), sp).alias("broad_roas"),
                    X.ratio0(F.coalesce("ads", F.lit(0.0)), sp).alias("ads_roas"),
                    F.coalesce("level", F.lit("healthy")).alias("level"))


def promo_days(rows: DataFrame) -> DataFrame:
    """R11 (D15): payday and mega-sale flags per (date, market), with the
    'M.D' label of mega-sale days."""
    g = rows.groupBy("date_local", "market").agg(
        F.max(F.col("is_payday").cast("int")).cast("boolean").alias("is_payday"),
        F.max(F.col("is_mega_sale").cast("int")).cast("boolean").alias("is_mega_sale"))
    label = F.concat_ws(".", F.month("date_local").cast("string"), F.dayofmonth("date_local").cast("string"))
    return g.withColumn("mega_label", F.when(F.col("is_mega_sale"), label))


def spine(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, both bounded by the
    calendar, the markets or the channels: ``right`` is folded into one array
    that is attached as a scalar and exploded, so no join is planned."""
    folded = right.agg(F.sort_array(F.collect_list(F.struct(*right.columns))).alias("_spine"))
    out = with_scalar(left, folded).withColumn("_x", F.explode("_spine"))
    return out.select(*left.columns, *[F.col(f"_x.{c}").alias(c) for c in right.columns])


def paid_channels(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(channel, priority): paid channels of the taxonomy, and channels of the
    data that it does not know (such as ``*_other``), last."""
    known = paid_taxonomy(taxonomy).select("channel", "priority")
    new = (rows.select("channel").distinct().join(F.broadcast(taxonomy.select("channel")), "channel", "left_anti")
           .where(F.col("channel").isNotNull()).select("channel", F.lit(99).alias("priority")))
    return known.unionByName(new)


def top_channel_stack(rows: DataFrame, taxonomy: DataFrame, p: Params) -> DataFrame:
    """The top paid channels by spend in the window (ties by priority),
    then their spend per date (0 when absent).

    Channels that the taxonomy lacks take part.
    """
    spend = rows.groupBy("channel").agg(F.sum("spend_usd").alias("total"))
    t = paid_channels(rows, taxonomy).join(spend, "channel", "left") \
        .withColumn("total", F.coalesce("total", F.lit(0.0)))
    order = Window.orderBy(F.col("total").desc(), "priority", "channel")
    top = t.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top_n_stack)
    days = spine(rows.select("date_local").distinct(), top.select("channel", "rank"))
    per_day = rows.groupBy("date_local", "channel").agg(F.sum("spend_usd").alias("spend"))
    return days.join(per_day, ["date_local", "channel"], "left").withColumn("spend", F.coalesce("spend", F.lit(0.0)))


def kpi_by_market(rows: DataFrame, dim_market: DataFrame) -> DataFrame:
    """The blended KPIs per market (all markets of the dimension)."""
    k = kpis(rows, ["market"])
    d = dim_market.select("market", "country_name").join(k, "market", "left")
    return d.select("market", "country_name",
                    *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("spend", "gmv", "orders", "ads_gmv", "roas")])


def market_trend(rows: DataFrame, dim_market: DataFrame, p: Params) -> DataFrame:
    """A15 series: de-duplicated platform GMV per (market of the dimension,
    date) over the last ``trend_days`` distinct dates (D18: no division by
    channel count)."""
    d = last_dates(rows, p.trend_days).select("date_local")
    r = rows.join(F.broadcast(d), "date_local")
    k = kpis(r, ["date_local", "market"]).select("date_local", "market", "gmv")
    return spine(d, dim_market.select("market")).join(k, ["date_local", "market"], "left") \
        .withColumn("gmv", F.coalesce("gmv", F.lit(0.0)))


# ------------------------------------------------------------------ channel brief
def channel_trend(rows: DataFrame, p: Params) -> DataFrame:
    """(spend, ROAS) per date of the last ``trend_days`` distinct dates
    for the focus channel (0 when it has no row that day)."""
    d = last_dates(rows, p.trend_days)
    r = market_filter(rows.join(F.broadcast(d.select("date_local")), "date_local"), p.market)
    is_c = F.col("channel") == p.focus_channel
    g = r.groupBy("date_local").agg(
        F.sum(F.when(is_c, F.col("spend_usd")).otherwise(0.0)).alias("spend"),
        F.sum(F.when(is_c, F.col("ads_gmv_usd")).otherwise(0.0)).alias("_gmv"))
    g = d.select("date_local").join(g, "date_local", "left").select(
        "date_local", F.coalesce("spend", F.lit(0.0)).alias("spend"), F.coalesce("_gmv", F.lit(0.0)).alias("_gmv"))
    return g.select("date_local", "spend", X.ratio0("_gmv", "spend").alias("roas"))


def heatmap(rows: DataFrame, dim_market: DataFrame, p: Params) -> DataFrame:
    """Market x date spend of the focus channel over the last
    ``heatmap_days`` distinct dates, 0 when missing, plus the maximum."""
    d = last_dates(rows, p.heatmap_days).select("date_local")
    r = rows.where(F.col("channel") == p.focus_channel).groupBy("date_local", "market") \
            .agg(F.sum("spend_usd").alias("value"))
    long = spine(d, dim_market.select("market")).join(r, ["date_local", "market"], "left") \
        .withColumn("value", F.coalesce("value", F.lit(0.0)))
    return long.withColumn("max_value", F.greatest(F.max("value").over(Window.partitionBy(F.lit(1))), F.lit(0.0)))


def channel_market_grid(rows: DataFrame, taxonomy: DataFrame, dim_market: DataFrame, p: Params) -> DataFrame:
    """Paid channel x market spend over the last 14 distinct dates, the
    window total, the total of the window before and the relative delta.

    D17: the prior window has the same length (14 dates); ``compat`` uses the
    reference's 7.
    """
    prev_n = 7 if p.compat else 14
    d = last_dates(rows, 14 + prev_n)
    d = d.withColumn("wk", F.when(F.col("date_rank") <= 14, "now").otherwise("prev"))
    cells = spine(spine(d.select("date_local", "wk"), dim_market.select("market")),
                  paid_channels(rows, taxonomy).select("channel"))
    keys = ["date_local", "channel", "market"]
    long = cells.join(rows.groupBy(*keys).agg(F.sum("spend_usd").alias("spend")), keys, "left") \
        .withColumn("spend", F.coalesce("spend", F.lit(0.0)))
    cell = Window.partitionBy("channel", "market")
    long = long.withColumn("now_total", F.sum(F.when(F.col("wk") == "now", F.col("spend")).otherwise(0.0)).over(cell)) \
               .withColumn("prev_total", F.sum(F.when(F.col("wk") == "prev", F.col("spend")).otherwise(0.0)).over(cell))
    out = long.where(F.col("wk") == "now").select(
        "channel", "market", "date_local", "spend", "now_total", "prev_total",
        F.when(F.col("prev_total") > 0, (F.col("now_total") - F.col("prev_total")) / F.col("prev_total"))
         .alias("delta"))
    return out


def period_compare(scan: DataFrame, p: Params) -> DataFrame:
    """W7 + A19: per paid channel, the filter window vs the window of the same
    length before it; spend, attributed GMV, ROAS and funnel ratios.

    Default windows are adjacent ([as_of-2n+1, as_of-n] before); ``compat``
    uses [as_of-2n, as_of-n) like the reference.
    """
    n = p.range_days
    d = F.col("date_local")
    now = d >= F.date_sub(F.lit(p.as_of), n - 1)
    if p.compat:
        prev = (d >= F.date_sub(F.lit(p.as_of), 2 * n)) & (d < F.date_sub(F.lit(p.as_of), n))
    else:
        prev = (d >= F.date_sub(F.lit(p.as_of), 2 * n - 1)) & (d <= F.date_sub(F.lit(p.as_of), n))
    r = market_filter(scan, p.market).where(F.col("group") != "organic")
    r = r.withColumn("period", F.when(now, "now").when(prev, "prev")).where(F.col("period").isNotNull())
    g = r.groupBy("channel", "period").agg(
        F.sum("spend_usd").alias("spend"), F.sum("ads_gmv_usd").alias("ads_gmv"),
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("ads_orders").alias("orders"))
    return g.select("channel", "period", "spend", "ads_gmv", "impressions", "clicks", "orders",
                    X.ratio0("ads_gmv", "spend").alias("roas"),
                    X.ratio0("clicks", "impressions").alias("ctr"),
                    X.ratio0("orders", "clicks").alias("cvr"))


def panel_meta(panel: DataFrame) -> DataFrame:
    """IO11: min / max date, row count, sorted markets and channels."""
    return panel.agg(
        F.min("date_local").alias("min_date"), F.max("date_local").alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws(",", F.sort_array(F.collect_set("market"))).alias("markets"),
        F.concat_ws(",", F.sort_array(F.collect_set("channel"))).alias("channels"))


def by_priority(df: DataFrame) -> DataFrame:
    """Channel priority order (unknown channels last, priority 99). Sort
    at the sink only."""
    pr = F.coalesce(F.col("priority"), F.lit(99)) if "priority" in df.columns else F.lit(99)
    return df.orderBy(pr, "channel")


def sink_order(rows: DataFrame) -> DataFrame:
    """The panel scan's order (date, market, channel), applied at the sink."""
    return rows.orderBy("date_local", "market", "channel")
