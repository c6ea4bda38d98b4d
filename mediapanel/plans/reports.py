"""Report compositions over one cached panel slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from .chain import Chain


def daily_report(c: Chain) -> dict[str, DataFrame]:
    """Daily series (A14), top channel stack (T2), share of spend vs
    GMV (A17), attribution ROAS with anomaly levels (A18 + R4) and the promo
    overlay (R11), all reading the same persisted panel."""
    return {
        "daily_series": M.daily_series(c.filtered),
        "top_channel_stack": M.top_channel_stack(c.filtered, c.taxonomy, c.p),
        "share_divergence": M.share_divergence(c.filtered, c.taxonomy, c.p),
        "attribution_roas": M.attribution_roas(c.filtered, c.taxonomy, c.levels),
        "promo_days": M.promo_days(c.filtered),
    }


def channel_brief(c: Chain, channel: str | None = None) -> dict[str, DataFrame]:
    """Period comparison with funnel ratios (W7 + A19), per-market KPIs
    and trend of the channel (A15), and the market x day heatmap (A16)."""
    from dataclasses import replace
    p = c.p if channel is None else replace(c.p, focus_channel=channel)
    ch = p.focus_channel
    rows = c.filtered.where(F.col("channel") == ch)
    return {
        "period_compare": M.period_compare(c.scan, p).where(F.col("channel") == ch),
        "by_market": M.kpi_by_market(rows, c.dim_market),
        "trend": M.channel_trend(c.scan, p),
        "heatmap": M.heatmap(c.scan, c.dim_market, p),
    }


def long_form(parts: dict[str, DataFrame], keys: dict[str, str | None]) -> DataFrame:
    """One frame of a report: (section, item, date_local, metric, value), each
    numeric or boolean column of a section a metric. ``keys`` names the column
    that tells a section's items apart."""
    out = None
    for section, df in parts.items():
        key = keys[section]
        dtypes = dict(df.dtypes)
        metrics = [c for c, t in df.dtypes if t in ("double", "bigint", "int", "boolean") and c not in ("priority",)]
        wide = df.select(F.lit(section).alias("section"),
                         (F.col(key) if key else F.lit(None)).cast("string").alias("item"),
                         (F.col("date_local") if "date_local" in dtypes else F.lit(None)).cast("date").alias("date_local"),
                         *[F.col(m).cast("int").cast("double").alias(m) if dtypes[m] == "boolean"
                           else F.col(m).cast("double").alias(m) for m in metrics])
        part = wide.unpivot(["section", "item", "date_local"], metrics, "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out
