"""Reference-compatible switches of the D-list (Params(compat=True))."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from mediapanel.config import DEFAULT
from mediapanel.operators import decisions, metrics
from mediapanel.plans.chain import Chain

from .conftest import SMALL, rows


def test_compat_switches(spark):
    new = Chain(spark, SMALL)
    old = Chain(spark, SMALL, replace(DEFAULT, compat=True))
    # TikTok Ads broad GMV is NULL in the reference, = direct here.
    tt = F.col("channel") == "tiktok_ads"
    assert new.panel.where(tt & F.col("broad_gmv_usd").isNull() & F.col("direct_gmv_usd").isNotNull()).count() == 0
    assert old.panel.where(tt & F.col("broad_gmv_usd").isNotNull()).count() == 0
    # The balancing step exists only in the corrected waterfall.
    kinds_new = {r["label"] for r in rows(decisions.waterfall(new.deltas, new.blended, new.p))}
    kinds_old = {r["label"] for r in rows(decisions.waterfall(old.deltas, old.blended, old.p))}
    assert "Unattributed" in kinds_new and "Unattributed" not in kinds_old
    # Month length (January has 31 days; the reference uses 30).
    assert {r["days_left"] for r in rows(decisions.pacing(new.scan, new.p))} == {1}
    assert {r["days_left"] for r in rows(decisions.pacing(old.scan, old.p))} == {0}
    # Grid prior window 14 vs 7 dates.
    g_new = rows(metrics.channel_market_grid(new.scan, new.taxonomy, new.dim_market, new.p).where("channel = 'meta_cpas' AND market = 'ID'"))
    g_old = rows(metrics.channel_market_grid(old.scan, old.taxonomy, old.dim_market, old.p).where("channel = 'meta_cpas' AND market = 'ID'"))
    assert g_new[0]["prev_total"] >= g_old[0]["prev_total"]
    # The reference sums all_conversions (which already include
    # view-assisted ones) for click-through rows.
    tot = [c.stg_evc.agg(F.sum("conversions")).first()[0] for c in (new, old)]
    assert tot[1] > tot[0]
