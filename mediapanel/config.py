"""Run parameters. Every operator takes ``as_of`` and thresholds from here
instead of the wall clock or hard-coded demo dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2024, 1, 30)
    # Facts are refreshed over the trailing window; None = full history.
    refresh_days: int | None = None
    evc_refresh_days: int | None = None
    # Days older than as_of - (final_lag - 1) are final (late-data policy).
    final_lag_days: int = 14
    # Panel scan window for analytics: [as_of - scan_days, as_of].
    scan_days: int = 30
    range_days: int = 14          # filter bar: 7 / 14 / 30, mtd = 20
    market: str = "all"
    evc: bool = False
    compat: bool = False          # reproduce reference quirks where cheap
    # Thresholds (taken as parameters; see README).
    material_spend: float = 5000.0
    waterfall_min_spend: float = 1500.0
    watchlist_min_spend: float = 1500.0
    watchlist_size: int = 7
    mix_min_spend: float = 1000.0
    anomaly_spend_floor: float = 1000.0
    share_floor: float = 0.005
    divergence: float = 0.05
    top_n_stack: int = 6
    top_n_waterfall: int = 6
    heatmap_days: int = 21
    trend_days: int = 14
    focus_channel: str = "google_ads_shopee"
    partner_min_spend: float = 3000.0
    # Pacing plan multipliers (plan = forecast x multiplier); fixed values of
    # the reference dashboard, used until a budget table is supplied.
    plan_mult: dict = field(default_factory=lambda: {
        "gmv": 1.04, "spend": 0.96, "orders": 1.02, "roas": 1.08})

    @property
    def as_of_str(self) -> str:
        return self.as_of.isoformat()


DEFAULT = Params()
