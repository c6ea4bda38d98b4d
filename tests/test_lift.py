"""Least squares fit, matched weeks and on / off switches on small frames."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest

from mediapanel.operators import features, lift

D = dt.date


def test_fit_matches_a_plain_solve(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for market, n in (("A", 200), ("B", 12), ("C", 5)):
        x = rng.normal(3, 2, (n, 6))
        x[:, 3] = 2 * x[:, 0] - x[:, 1]      # depends on others
        x[:, 4] = 7.5                        # constant
        y = 1 + x[:, 0] - 0.5 * x[:, 2] + rng.normal(0, 0.1, n)
        rows += [(market, *map(float, r), float(t)) for r, t in zip(x, y)]
        mean, sd = x.mean(0), x.std(0)
        z = np.where(sd > 1e-9, (x - mean) / np.where(sd > 1e-9, sd, 1), 0)
        v = (y - y.mean()) / y.std()
        r = z.T @ z / n
        b = np.linalg.solve(r + features.RIDGE * np.eye(6), z.T @ v / n)
        coef = np.where(sd > 1e-9, b * y.std() / np.where(sd > 1e-9, sd, 1), 0)
        want[market] = (coef, b, y.mean() - coef @ mean, 1 - ((v - z @ b) ** 2).mean(), n)
    terms = [f"t{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ["market", *terms, "y"]).repartition(4)
    got = {(r.market, r.term): r for r in features.regression_fit(df, terms).collect()}
    assert len(got) == 3 * 7
    for market, (coef, b, intercept, r2, n) in want.items():
        for i, t in enumerate(terms):
            assert got[market, t].coefficient == pytest.approx(coef[i], abs=1e-8)
            assert got[market, t].beta == pytest.approx(b[i], abs=1e-8)
            assert got[market, t].n == n and got[market, t].r2 == pytest.approx(r2, abs=1e-8)
        assert got[market, "(intercept)"].coefficient == pytest.approx(intercept, abs=1e-7)
    assert abs(want["A"][0][2] + 0.5) < 0.05  # the effect that was put in


def test_fit_of_nulls_and_constant_targets(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0), ("A", None, 5.0), ("A", 3.0, 5.0)], "market string, t double, y double")
    got = {r.term: r for r in features.regression_fit(df, ["t"]).collect()}
    assert got["t"].coefficient == 0 and got["t"].r2 is None and got["(intercept)"].coefficient == pytest.approx(5)
    assert features.regression_fit(df.limit(0), ["t"]).count() == 0


def daily(spark, rows):
    return spark.createDataFrame(rows, "market string, platform string, campaign_id string, date_local date, spend double, gmv double")


def test_matched_weeks_match_brute_force(spark):
    rng = random.Random(2)
    monday = D(2024, 1, 1)
    rows = []
    for c in range(60):
        for w in range(12):
            if rng.random() < 0.85:
                rows.append(("ID" if c % 3 else "SG", f"p{c % 2}", None if c == 5 else f"c{c}", monday + dt.timedelta(7 * w + rng.randint(0, 6)),
                             0.0 if c < 20 else 10 ** rng.uniform(0, 4), 10 ** rng.uniform(0, 5)))
    sales = [(D(2024, 1, 24), "ID"), (D(2024, 1, 25), "ID"), (D(2024, 2, 14), "SG"), (D(2024, 3, 6), "ID")]
    got = lift.matched_weeks(daily(spark, rows), spark.createDataFrame(sales, "date date, market string")).collect()
    week = lambda d: d - dt.timedelta(d.weekday())
    sums: dict = {}
    for m, p, c, d, s, g in rows:
        at = sums.setdefault((m, p, c, week(d)), [0.0, 0.0])
        at[0] += s
        at[1] += g
    cell = lambda x: math.floor(math.log1p(x) / lift.GRID + 0.5)
    sale = {(m, week(d)) for d, m in sales}
    units = []
    for (m, p, c, w), (s, g) in sums.items():
        if (pre := sums.get((m, p, c, w - dt.timedelta(7)))) is not None:
            units.append((m, p, c, w, g, cell(pre[0]), cell(pre[1]), (m, w) in sale))
    want = {}
    for m, p, c, w, g, a, b, on in units:
        if on:
            near = [((a - x[5]) ** 2 + (b - x[6]) ** 2, x[5], x[6]) for x in units if x[:2] == (m, p) and not x[7]
                    and abs(a - x[5]) <= lift.CALIPER and abs(b - x[6]) <= lift.CALIPER]
            if near:
                best = min(near)
                held = [x[4] for x in units if x[:2] == (m, p) and not x[7] and (x[5], x[6]) == best[1:]]
                want[m, p, c, w] = (best[0], len(held), sum(held) / len(held), g - sum(held) / len(held))
            else:
                want[m, p, c, w] = (None, None, None, None)
    assert len(got) == len(want) > 20 and any(v[0] is None for v in want.values())
    for r in got:
        distance, n, baseline, up = want[r.market, r.platform, r.campaign_id, r.week]
        assert (r.distance, r.matched_weeks) == (distance, n)
        assert r.baseline_gmv == (pytest.approx(baseline) if n else None) and r.lift == (pytest.approx(up) if n else None)


def test_pairs_are_bounded_by_cells(spark):
    """Very many weeks of one cell are one candidate row."""
    rows = [("ID", "p", f"c{i}", D(2024, 1, 1) + dt.timedelta(7 * w), 5.0, 7.0) for i in range(300) for w in range(4)]
    got = lift.matched_weeks(daily(spark, rows), spark.createDataFrame([(D(2024, 1, 16), "ID")], "date date, market string"))
    assert {(r.matched_weeks, r.distance, r.lift) for r in got.collect()} == {(600, 0, 0.0)} and got.count() == 300


def test_switches(spark):
    day = lambda n: D(2024, 1, 1) + dt.timedelta(n)
    rows = [("ID", "p", "c", day(i), 10.0, 1.0) for i in range(7)] + [("ID", "p", "c", day(i), 0.0, 0.0) for i in (8, 9)]
    rows += [("ID", "p", "c", day(i), 10.0, 1.0) for i in (12, 14, 18)]     # off on 7-11; on 13 too short; off on 15-17
    rows += [("SG", "p", "lone", day(3), 5.0, 1.0)]
    gmv = [("ID", day(i), 100.0 if i < 7 or i > 11 else 60.0) for i in range(28)]
    market = spark.createDataFrame(gmv, "market string, date_local date, gmv double")
    got = {r.off_from: r for r in lift.on_off(daily(spark, rows), market).collect()}
    assert set(got) == {day(7), day(15)}
    r = got[day(7)]
    assert (r.off_to, r.pre_days, r.off_days, r.pre_spend) == (day(11), 7, 5, 10.0)
    index = {}
    for _, d, g in gmv:
        index.setdefault(d.weekday(), []).append(g)
    mean = sum(g for _, _, g in gmv) / len(gmv)
    adjusted = {d: g / (sum(index[d.weekday()]) / len(index[d.weekday()]) / mean) for _, d, g in gmv}
    pre = sum(adjusted[day(i)] for i in range(7)) / 7
    off = sum(adjusted[day(i)] for i in range(7, 12)) / 5
    assert r.pre_gmv == pytest.approx(pre) and r.off_gmv == pytest.approx(off)
    assert r.lift == pytest.approx(pre - off) and r.return_on_spend == pytest.approx((pre - off) / 10)
    # Days without GMV are in neither mean.
    none = lift.on_off(daily(spark, rows), market.where("date_local < '2024-01-01'")).collect()
    assert {(x.pre_days, x.off_days, x.lift) for x in none} == {(0, 0, None)}
