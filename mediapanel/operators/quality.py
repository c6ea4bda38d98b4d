"""Data-quality suite (Q1-Q15): each check is a predicate on the rows of a table
or a DataFrame of violating rows; the runner counts all of them in one job.

Q13 runner: predicates on one table share one pass over it (``count_if`` per
check); the violations of other checks are counted where they are. The counts
are one union, so one job. If that job fails, every check is run on its own,
and those that fail again are reported as ERROR. Only counts reach the
driver, never the violating rows themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.seeds import DQ_EPS, DQ_GMV_BOUND, META_ALLOWED_WINDOWS


@dataclass(frozen=True)
class RowCheck:
    """A predicate that no row of ``table()`` may meet; checks of one ``name``
    share a pass."""
    name: str
    table: Callable[[], DataFrame]
    violated: Column

    def rows(self) -> DataFrame:
        return self.table().where(self.violated)


def evc_bounded() -> Column:
    return F.col("evc_conversions") > F.col("all_conversions") + DQ_EPS


def no_negative() -> Column:
    cols = ("spend_usd", "impressions", "clicks", "ads_attributed_orders", "ads_attributed_gmv_usd")
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in cols])


def funnel_monotone() -> Column:
    return (F.col("spend_usd") > 0) & (F.coalesce(F.col("impressions") < F.col("clicks"), F.lit(False))
                                       | F.coalesce(F.col("clicks") < F.col("ads_attributed_orders"), F.lit(False)))


def voucher_bounded() -> Column:
    return F.col("Voucher_subsidy") > F.col("Spend") + DQ_EPS


def direct_leq_broad_orders() -> Column:
    return F.col("Direct_orders") > F.col("Broad_orders")


def grain_null() -> Column:
    return F.col("date_local").isNull() | F.col("market").isNull() | F.col("channel").isNull()


def direct_leq_broad_gmv() -> Column:
    return F.col("direct_gmv_usd") > F.col("broad_gmv_usd") + DQ_EPS


def q02_ads_gmv_bounded(panel: DataFrame) -> DataFrame:
    g = panel.where(F.col("platform_total_gmv_usd").isNotNull()).groupBy("date_local", "market", "platform").agg(
        F.sum("ads_attributed_gmv_usd").alias("ads_gmv"), F.max("platform_total_gmv_usd").alias("plat_gmv"))
    return g.where(F.col("ads_gmv") > DQ_GMV_BOUND * F.col("plat_gmv"))


def q06_every_market(panel: DataFrame, dim_market: DataFrame) -> DataFrame:
    """Anti join (a NULL panel market cannot hide a missing market)."""
    present = panel.select("market").where(F.col("market").isNotNull()).distinct()
    return dim_market.select("market").join(present, "market", "left_anti")


def q08_channel_in_taxonomy(panel: DataFrame, taxonomy: DataFrame) -> DataFrame:
    ch = panel.select("channel").distinct()
    return ch.join(F.broadcast(taxonomy.select("channel")), "channel", "left_anti") \
             .where(~F.col("channel").endswith("_other"))


def q10_meta_windows(evc_meta_raw: DataFrame) -> DataFrame:
    return evc_meta_raw.select("attribution_window").distinct() \
                       .where(~F.col("attribution_window").isin(*META_ALLOWED_WINDOWS))


def q11_mega_sale_flag(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    pd_ = panel.select(F.col("date_local").alias("date"), "market", "is_mega_sale").distinct()
    seed = calendar.select("date", "market").distinct().withColumn("in_seed", F.lit(True))
    j = pd_.join(F.broadcast(seed), ["date", "market"], "left")
    return j.where(~F.col("is_mega_sale").eqNullSafe(F.coalesce("in_seed", F.lit(False))))


def q14_unique_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    """Ours: duplicate grain keys (null-safe) in a fact or mart."""
    return df.groupBy(*grain).count().where(F.col("count") > 1)


def q15_fx_coverage(fact_sales: DataFrame, fx: DataFrame) -> DataFrame:
    """Ours: (date, currency) pairs used by the sales fact without an FX rate."""
    used = fact_sales.select(F.col("date_local").alias("date"), "currency").distinct()
    return used.join(F.broadcast(fx.select("date", "currency")), ["date", "currency"], "left_anti")


def checks(chain) -> dict[str, RowCheck | Callable[[], DataFrame]]:
    """Check id -> predicate or violations builder, wired to a ``Chain`` whose
    facts and marts are written tables."""
    c = chain
    from .facts import KEYS

    def on(name, violated):
        source = {"panel": lambda: c.panel, "panel_evc": lambda: c.panel_evc,
                  "shopee_ads": lambda: c.raw["shopee_ads_daily"]}[name]
        return RowCheck(name, source, violated)
    out = {
        "Q01_evc_within_all": on("panel_evc", evc_bounded()),
        "Q02_ads_gmv_within_platform": lambda: q02_ads_gmv_bounded(c.panel),
        "Q03_no_negatives": on("panel", no_negative()),
        "Q04_funnel_order": on("panel", funnel_monotone()),
        "Q05_voucher_within_spend": on("shopee_ads", voucher_bounded()),
        "Q06_all_markets": lambda: q06_every_market(c.panel, c.dim_market),
        "Q07_grain_not_null": on("panel", grain_null()),
        "Q08_known_channels": lambda: q08_channel_in_taxonomy(c.panel, c.taxonomy),
        "Q09_direct_orders_within_broad": on("shopee_ads", direct_leq_broad_orders()),
        "Q10_meta_windows": lambda: q10_meta_windows(c.raw["evc_meta"]),
        "Q11_mega_sale_flag": lambda: q11_mega_sale_flag(c.panel, c.calendar),
        "Q12_direct_gmv_within_broad": on("panel", direct_leq_broad_gmv()),
        "Q15_fx_coverage": lambda: q15_fx_coverage(c.fact_platform_sales, c.fx),
    }
    for name, key in KEYS.items():
        out[f"Q14_unique_{name}"] = lambda n=name, k=key: q14_unique_grain(getattr(c, n), k)
    return out


def _counted(builders: dict[str, RowCheck | Callable[[], DataFrame]]) -> list[DataFrame]:
    """(check, rows) of all checks: one frame per shared table and one per
    other check."""
    shared: dict[str, dict[str, RowCheck]] = {}
    out = []
    for name, check in builders.items():
        if isinstance(check, RowCheck):
            shared.setdefault(check.name, {})[name] = check
        else:
            out.append(check().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("check"), "rows"))
    for group in shared.values():
        counts = next(iter(group.values())).table().agg(*[F.count_if(x.violated).alias(n) for n, x in group.items()])
        out.append(counts.unpivot([], list(group), "check", "rows"))
    return out


def dq_suite(spark, builders: dict[str, RowCheck | Callable[[], DataFrame]]) -> DataFrame:
    """Q13: one row per check: check, status (PASS / FAIL / ERROR), rows (-1 on
    error). All counts come from one job; only if it fails, or a plan cannot
    be built, are the checks run one by one to find those at fault."""
    def run(part) -> dict[str, int]:
        frames = _counted(part)
        return {r["check"]: r["rows"] for r in reduce(DataFrame.unionByName, frames).collect()} if frames else {}

    try:
        counts = run(builders)
    except Exception:  # noqa: BLE001 - the checks at fault are reported below
        counts = {}
        for name, check in builders.items():
            try:
                counts |= run({name: check})
            except Exception:  # noqa: BLE001 - a broken check is reported, not raised
                counts[name] = -1
    status = lambda n: "ERROR" if n < 0 else "PASS" if n == 0 else "FAIL"
    return spark.createDataFrame([(n, status(counts[n]), counts[n]) for n in builders],
                                 "check string, status string, rows long")


def suite_exit_status(report: DataFrame) -> int:
    """Q13 exit status: 0 when every check passed, 1 otherwise. Reads only
    the report (one row per check), never violating rows."""
    bad = report.where(F.col("status") != "PASS").limit(1).count()
    return 0 if bad == 0 else 1
