"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.seeds import AD_TYPE_KEYWORDS, CANCELLED_STATUSES, COMPLETED_STATUSES


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date(ts, tz) -> Column:
    """PF2: UTC instant -> market-local calendar date; NULL tz -> NULL."""
    return F.to_date(F.from_utc_timestamp(col(ts), col(tz)))


def week_monday(d) -> Column:
    """PF12: Monday-based week of year; days before the first Monday are week 0
    (not ISO ``weekofyear``)."""
    d = col(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("long")


def is_weekend(d) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def is_payday(d, days=(1, 15, 16)) -> Column:
    return F.dayofmonth(col(d)).isin(*days)


def usd(amount, rate) -> Column:
    """PF8: local amount / local-per-USD rate as double; missing or zero rate
    gives NULL (SAFE_DIVIDE)."""
    return F.try_divide(col(amount).cast("double"), col(rate).cast("double"))


def ratio0(num, den) -> Column:
    """Guarded ratio: 0 when the denominator is not positive."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0))


def pct_delta(now, prev) -> Column:
    """(now - prev) / prev, NULL when prev is 0 or NULL."""
    return F.when((col(prev) != 0) & col(prev).isNotNull(),
                  (col(now) - col(prev)) / col(prev))


def js_round(x) -> Column:
    """Dashboard rounding (half up toward +inf): floor(x + 0.5)."""
    return F.floor(col(x) + F.lit(0.5))


def cancelled_flag(status) -> Column:
    """PF3: NULL status -> NULL flag."""
    return col(status).isin(*CANCELLED_STATUSES)


def completed_flag(status) -> Column:
    return col(status).isin(*COMPLETED_STATUSES)


def ad_type_from_objective(objective) -> Column:
    """PF4: ordered substring classification, first match wins."""
    o = F.lower(col(objective))
    out = None
    for k in AD_TYPE_KEYWORDS:
        out = (F.when if out is None else out.when)(o.like(f"%{k}%"), k)
    return out.otherwise("other")


def working_spend(spend, voucher) -> Column:
    """PF5: max(coalesce(spend,0) - coalesce(voucher,0), 0)."""
    return F.greatest(F.coalesce(col(spend), F.lit(0)) - F.coalesce(col(voucher), F.lit(0)), F.lit(0))


def round4(c) -> Column:
    return F.round(col(c).cast("double"), 4)
