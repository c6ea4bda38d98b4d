"""X2 at campaign grain: matched weeks (seasonal lift against a counterfactual)
and on / off switches of campaigns.

Both start from daily campaign rows of the two ads facts, which are bounded by
campaigns x days whatever the row volume behind the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAMPAIGN = ["market", "platform", "campaign_id"]
GRID = 0.25        # width of a covariate cell, in log units
CALIPER = 4        # cells apart that two weeks may be in each covariate
LEAST_OFF = 3      # days without spend that make a switch
PRE_DAYS = 7


def campaign_daily(onplatform: DataFrame, offplatform: DataFrame) -> DataFrame:
    """(market, platform, campaign_id, date_local, spend, gmv): attributed GMV
    is the broad one, else the direct one, else the reported purchase value."""
    def of(fact, gmv):
        return fact.select(*CAMPAIGN, "date_local", F.coalesce(F.col("spend_usd").cast("double"), F.lit(0.0)).alias("spend"),
                           F.coalesce(gmv.cast("double"), F.lit(0.0)).alias("gmv"))
    rows = of(onplatform, F.coalesce("broad_gmv_usd", "direct_gmv_usd")).unionByName(
        of(offplatform, F.col("purchase_value_reported_usd")))
    return rows.groupBy(*CAMPAIGN, "date_local").agg(F.sum("spend").alias("spend"), F.sum("gmv").alias("gmv"))


def _week(col: str):
    return F.date_trunc("week", col).cast("date")


def matched_weeks(daily: DataFrame, sale_days: DataFrame, grid: float = GRID, caliper: int = CALIPER) -> DataFrame:
    """Lift of each campaign's sale weeks over the matched non-sale weeks of the
    same market and platform.

    A week's covariates are the spend and GMV of the week before it, in log
    units and on a grid of cells; weeks whose campaign has no row the week before
    have no pre-period and are left out. The match of a sale week is the nearest
    cell (squared distance, then the smaller cell) within ``caliper`` cells in
    both covariates that holds non-sale weeks; the baseline is their mean GMV.
    Sale weeks without a match keep null.

    Weeks of one cell are one candidate, so pairs are bounded by the grid and
    not by the number of weeks, however many share a cell; candidates are found
    by an equi-join on buckets of ``caliper`` cells and their neighbours, which
    hold every cell within the caliper."""
    weeks = daily.groupBy(*CAMPAIGN, _week("date_local").alias("week")).agg(
        F.sum("spend").alias("spend"), F.sum("gmv").alias("gmv"))
    before = Window.partitionBy(*CAMPAIGN).orderBy("week")
    follows = F.lag("week").over(before) == F.date_sub("week", 7)
    # Weeks x markets with a sale day: bounded by the calendar.
    sales = sale_days.select("market", _week("date").alias("week")).distinct().withColumn("_sale", F.lit(True))
    units = (weeks.withColumn("pre_spend", F.when(follows, F.lag("spend").over(before)))
             .withColumn("pre_gmv", F.when(follows, F.lag("gmv").over(before)))
             .where(F.col("pre_spend").isNotNull())
             .join(F.broadcast(sales), ["market", "week"], "left")
             .withColumn("c1", F.round(F.log1p("pre_spend") / grid).cast("int"))
             .withColumn("c2", F.round(F.log1p("pre_gmv") / grid).cast("int")))
    cell = ["market", "platform", "c1", "c2"]
    treated = units.where("_sale").drop("_sale")
    candidates = (units.where("_sale IS NULL").groupBy(*cell)
                  .agg(F.count(F.lit(1)).alias("matched_weeks"), F.avg("gmv").alias("baseline_gmv"))
                  .select("market", "platform", F.floor(F.col("c1") / caliper).alias("b1"), F.floor(F.col("c2") / caliper).alias("b2"),
                          F.struct("c1", "c2", "matched_weeks", "baseline_gmv").alias("m")))
    around = lambda c: F.explode(F.sequence(F.floor(F.col(c) / caliper) - 1, F.floor(F.col(c) / caliper) + 1))
    asked = treated.select(*cell).distinct().withColumn("b1", around("c1")).withColumn("b2", around("c2"))
    d1, d2 = F.col("c1") - F.col("m.c1"), F.col("c2") - F.col("m.c2")
    nearest = (asked.join(candidates, ["market", "platform", "b1", "b2"])
               .where((F.abs(d1) <= caliper) & (F.abs(d2) <= caliper))
               .groupBy(*cell).agg(F.array_min(F.collect_list(F.struct(
                   (d1 * d1 + d2 * d2).alias("distance"), "m.c1", "m.c2", "m.matched_weeks", "m.baseline_gmv"))).alias("best")))
    out = treated.join(nearest, cell, "left")
    lift = F.col("gmv") - F.col("best.baseline_gmv")
    return out.select(*CAMPAIGN, "week", "spend", "gmv", "pre_spend", "pre_gmv",
                      F.col("best.matched_weeks").alias("matched_weeks"), F.col("best.distance").alias("distance"),
                      F.col("best.baseline_gmv").alias("baseline_gmv"), lift.alias("lift"),
                      F.try_divide(lift, F.col("best.baseline_gmv")).alias("lift_share"))


def seasonally_adjusted(market_daily: DataFrame) -> DataFrame:
    """(market, date_local, gmv) with GMV divided by the market's day-of-week
    index (mean of the weekday over the mean of all days)."""
    by_day = Window.partitionBy("market", F.dayofweek("date_local"))
    index = F.try_divide(F.avg("gmv").over(by_day), F.avg("gmv").over(Window.partitionBy("market")))
    return market_daily.select("market", "date_local", F.try_divide(F.col("gmv"), index).alias("adjusted"))


def on_off(daily: DataFrame, market_daily: DataFrame, least_off: int = LEAST_OFF, pre_days: int = PRE_DAYS) -> DataFrame:
    """One row per switch: a stretch of at least ``least_off`` days between two
    days with spend on which the campaign spent nothing. The market's seasonally
    adjusted GMV of those days is compared with that of the ``pre_days`` days
    before them, which are the campaign's own control; days without a GMV row
    are in neither mean."""
    by_day = Window.partitionBy(*CAMPAIGN).orderBy("date_local")
    switches = (daily.where("spend > 0").withColumn("_last", F.lag("date_local").over(by_day))
                .where(F.datediff("date_local", "_last") > least_off)
                .select(*CAMPAIGN, F.date_add("_last", 1).alias("off_from"), F.date_sub("date_local", 1).alias("off_to")))
    key = [*CAMPAIGN, "off_from", "off_to"]
    days = switches.select(*key, F.explode(F.sequence(F.date_sub("off_from", pre_days), "off_to")).alias("date_local"))
    off = F.col("date_local") >= F.col("off_from")
    # The series of the markets: bounded by markets x days.
    seen = (days.join(seasonally_adjusted(market_daily), ["market", "date_local"], "left")
            .join(daily, [*CAMPAIGN, "date_local"], "left"))
    out = seen.groupBy(*key).agg(
        F.count(F.when(~off, F.col("adjusted"))).alias("pre_days"), F.count(F.when(off, F.col("adjusted"))).alias("off_days"),
        F.avg(F.when(~off, F.col("adjusted"))).alias("pre_gmv"), F.avg(F.when(off, F.col("adjusted"))).alias("off_gmv"),
        (F.sum(F.when(~off, F.coalesce("spend", F.lit(0.0)))) / pre_days).alias("pre_spend"))
    effect = F.col("pre_gmv") - F.col("off_gmv")
    return out.select(*key, "pre_days", "off_days", "pre_gmv", "off_gmv", "pre_spend", effect.alias("lift"),
                      F.try_divide(effect, F.col("pre_spend")).alias("return_on_spend"))
