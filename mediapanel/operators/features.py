"""Model inputs built on the panel (X1-X4): regression frame and its least
squares fit, lift inputs (difference in differences), traffic-split organic
channels, keyword-grain ads fact. Lift at campaign grain is in ``lift``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.seeds import PAID_CHANNELS


def daily_market_gmv(panel: DataFrame) -> DataFrame:
    """De-duplicated platform GMV per (date, market): the total repeats on
    every channel row of a platform, so take it once per platform."""
    per_platform = panel.groupBy("date_local", "market", "platform").agg(
        F.max(F.coalesce("platform_total_gmv_usd", F.lit(0.0))).alias("gmv"))
    return per_platform.groupBy("date_local", "market").agg(F.sum("gmv").alias("gmv"))


def regression_frame(panel: DataFrame, weekly: bool = False) -> DataFrame:
    """One row per (market, day) (or Monday-based week): target
    log(gmv + 1), log(1 + spend) and log(1 + impressions) per paid channel
    (wide, the columns of the known paid channels and ``x_other``, ``i_other``
    for those of all others; 0 when absent) and the calendar covariates."""
    gmv = daily_market_gmv(panel)
    p = panel
    if weekly:
        def to_week(df):
            return df.withColumn("date_local", F.date_trunc("week", "date_local").cast("date"))
        gmv = to_week(gmv).groupBy("date_local", "market").agg(F.sum("gmv").alias("gmv"))
        p = to_week(panel)
    name = F.when(F.col("channel").isin(*PAID_CHANNELS), F.col("channel")).otherwise("other")
    media = p.withColumn("channel", name).groupBy("date_local", "market") \
        .pivot("channel", PAID_CHANNELS + ["other"]).agg(F.sum("spend_usd").alias("x"), F.sum("impressions").alias("i"))
    cov = p.groupBy("date_local", "market").agg(
        F.max(F.col("is_weekend").cast("int")).alias("is_weekend"),
        F.max(F.col("is_payday").cast("int")).alias("is_payday"),
        F.max(F.col("is_mega_sale").cast("int")).alias("is_mega_sale"),
        F.max("week_of_year").alias("week_of_year"))
    f = gmv.join(media, ["date_local", "market"], "left").join(cov, ["date_local", "market"], "left")
    return f.select("market", "date_local", F.log1p("gmv").alias("y"),
                    *[F.log1p(F.coalesce(F.col(f"{c}_{k}").cast("double"), F.lit(0.0))).alias(f"{k}_{c}")
                      for k in ("x", "i") for c in PAID_CHANNELS + ["other"]],
                    "is_weekend", "is_payday", "is_mega_sale", "week_of_year")


RIDGE = 0.01
CONSTANT = 1e-10  # variance, relative to 1 + mean squared, below which a term is constant


def regression_fit(frame: DataFrame, terms: list[str], y: str = "y", ridge: float = RIDGE) -> DataFrame:
    """Coefficients of the regression of ``y`` on ``terms`` per market, by
    ridge regression on standardised terms: (market, term, coefficient, beta, n,
    r2), one row per term and ``(intercept)``. A coefficient is per unit of its
    term, beta per standard deviation of term and target. Terms that are
    constant in a market get 0; nulls count as 0. The ridge settles terms that
    depend on each other and markets with fewer rows than terms.

    One aggregate sums the cross products of a market (combined before the
    shuffle, so a market may have any share of the rows); what follows are p x p
    matrices, one row per market, solved by Gauss-Jordan elimination inside
    array functions. With the ridge the matrix is positive definite, so the
    diagonal pivots as it comes."""
    p = len(terms)
    z = F.array(F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in [*terms, y]])
    rows = frame.select("market", z.alias("z"))
    pairs = F.flatten(F.transform("z", lambda a, i: F.transform("z", lambda b, j: F.struct(
        i.alias("i"), j.alias("j"), (a * b).alias("v")))))
    sums = (rows.select("market", F.inline(pairs)).groupBy("market", "i", "j").agg(F.sum("v").alias("v"))
            .groupBy("market").agg(F.sort_array(F.collect_list(F.struct("i", "j", "v")))["v"].alias("s")))
    at = lambda i, j: F.get(F.col("s"), i * (p + 2) + j)
    n, terms_ = F.get(F.col("s"), F.lit(0)), F.sequence(F.lit(1), F.lit(p + 1))
    mean = sums.select("market", "s", n.alias("n"), F.transform(terms_, lambda i: at(F.lit(0), i) / n).alias("mean"))
    m = lambda i: F.get(F.col("mean"), i - 1)
    cov = lambda i, j: at(i, j) / F.col("n") - m(i) * m(j)
    scale = F.transform(terms_, lambda i: F.when(cov(i, i) > CONSTANT * (1 + m(i) * m(i)), F.sqrt(cov(i, i))).otherwise(F.lit(0.0)))
    scaled = mean.withColumn("scale", scale)
    d = lambda i: F.get(F.col("scale"), i - 1)
    corr = lambda i, j: F.when((d(i) > 0) & (d(j) > 0), cov(i, j) / (d(i) * d(j))).otherwise(F.lit(0.0))
    r = scaled.withColumn("r", F.transform(terms_, lambda i: F.transform(terms_, lambda j: corr(i, j))))
    augmented = F.transform(F.slice("r", 1, p), lambda row, i: F.transform(
        row, lambda v, j: F.when(i == j, v + ridge).otherwise(v)))

    def eliminate(a, k):
        pivot = F.get(a, k)
        return F.transform(a, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / F.get(pivot, k))).otherwise(
            F.zip_with(row, pivot, lambda v, q: v - F.get(row, k) * q / F.get(pivot, k))))

    solved = r.withColumn("solved", F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), augmented, eliminate))
    beta = solved.withColumn("beta", F.transform("solved", lambda row: F.get(row, F.lit(p))))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda t, v: t + v)
    # 1 - |y - fit|^2 of the standardised target
    b, ry = F.col("beta"), F.transform(F.slice("r", 1, p), lambda row: F.get(row, F.lit(p)))
    quad = dot(b, F.transform(F.slice("r", 1, p), lambda row: dot(b, F.slice(row, 1, p))))
    sy, my = F.get(F.col("scale"), F.lit(p)), F.get(F.col("mean"), F.lit(p))
    coef = F.zip_with("beta", F.slice("scale", 1, p), lambda v, s: F.when(s > 0, v * sy / s).otherwise(F.lit(0.0)))
    fit = beta.select("market", F.col("n").cast("long").alias("n"), F.when(sy > 0, 2 * dot(b, ry) - quad).alias("r2"),
                      "beta", "mean", coef.alias("coef"), my.alias("my"))
    named = F.concat(
        F.array(F.struct(F.lit("(intercept)").alias("term"),
                         (F.col("my") - dot(F.col("coef"), F.slice("mean", 1, p))).alias("coefficient"), F.lit(0.0).alias("beta"))),
        F.zip_with(F.array(*[F.lit(c) for c in terms]), F.arrays_zip("coef", "beta"), lambda t, v: F.struct(
            t.alias("term"), v["coef"].alias("coefficient"), v["beta"].alias("beta"))))
    return fit.select("market", "n", "r2", F.inline(named)).select("market", "term", "coefficient", "beta", "n", "r2")


def lift_did(panel: DataFrame, treated: list[str], pre: tuple[dt.date, dt.date],
             post: tuple[dt.date, dt.date]) -> DataFrame:
    """Mean daily de-duplicated GMV of treated vs control markets before
    and during an intervention, and the difference in differences."""
    g = daily_market_gmv(panel)
    d = F.col("date_local")
    period = F.when(d.between(F.lit(pre[0]), F.lit(pre[1])), "pre") \
              .when(d.between(F.lit(post[0]), F.lit(post[1])), "post")
    grp = F.when(F.col("market").isin(*treated), "treated").otherwise("control")
    g = g.withColumn("period", period).withColumn("grp", grp).where(F.col("period").isNotNull())
    a = g.groupBy().agg(*[
        F.avg(F.when((F.col("grp") == gr) & (F.col("period") == pe), F.col("gmv"))).alias(f"{gr}_{pe}")
        for gr in ("treated", "control") for pe in ("pre", "post")])
    return a.withColumn("did", (F.col("treated_post") - F.col("treated_pre"))
                        - (F.col("control_post") - F.col("control_pre")))


def traffic_split_organic(fact_sales: DataFrame) -> DataFrame:
    """X3 (off by default in the panel): live / video organic channels of the
    TikTok shop from the traffic mix: GMV x share of order lines per source."""
    t = fact_sales.where(F.col("platform") == "tiktok_shop").select(
        "date_local", "market", "gmv_net_usd", "orders_gross", F.explode("traffic_source_mix").alias("m"))
    t = t.where(F.col("m.traffic_source").isin("live", "video")).select(
        "date_local", "market",
        F.concat(F.lit("tiktok_shop_"), F.col("m.traffic_source")).alias("channel"),
        (F.col("gmv_net_usd") * F.col("m.cnt") / F.col("orders_gross")).alias("gmv_usd"))
    return t.groupBy("date_local", "market", "channel").agg(F.sum("gmv_usd").alias("gmv_usd"))


def keyword_fact(stg_onplatform: DataFrame) -> DataFrame:
    """On-platform ads fact at keyword grain (Shopee keyword / TikTok ad
    kept as ``ad_key``)."""
    keys = ["date_local", "market", "platform", "ad_type", "campaign_id", "sku_id", "ad_key"]
    return stg_onplatform.groupBy(*keys).agg(
        F.sum("spend_usd").alias("spend_usd"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"), F.sum("broad_orders").alias("broad_orders"),
        F.sum("broad_gmv_usd").alias("broad_gmv_usd"))
