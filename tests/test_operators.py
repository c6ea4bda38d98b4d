"""Operator properties on micro fixtures: upsert, KPIs, story, decisions,
media response, IO, data quality."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from mediapanel.config import Params
from mediapanel.operators import decisions, features, metrics, quality, response, upsert
from mediapanel.sources import io, schemas, seeds

from .conftest import rows

D = dt.date


# ------------------------------------------------------------------ upsert
def test_upsert_null_safe_and_idempotent(spark):
    t = spark.createDataFrame([(D(2024, 1, 1), "a", None, 1.0), (D(2024, 1, 2), "b", "x", 2.0)],
                              "date_local date, k string, g string, v double")
    s = spark.createDataFrame([(D(2024, 1, 1), "a", None, 9.0), (D(2024, 1, 3), "c", None, 3.0)],
                              "date_local date, k string, g string, v double")
    once = upsert.upsert(t, s, ["date_local", "k", "g"])
    twice = upsert.upsert(once, s, ["date_local", "k", "g"])
    assert sorted(rows(once), key=str) == sorted(rows(twice), key=str)
    got = {(r["k"], r["v"]) for r in rows(once)}
    assert got == {("a", 9.0), ("b", 2.0), ("c", 3.0)}                 # NULL key matched, not re-inserted
    full = upsert.upsert(t, s, ["date_local", "k", "g"], replace_from=D(2024, 1, 2))
    assert {r["k"] for r in rows(full)} == {"a", "c"}                     # vanished row in window dropped


def test_insert_if_missing_never_updates(spark):
    t = spark.createDataFrame([(D(2024, 1, 1), "IDR", 1.0)], "date date, currency string, usd_rate double")
    s = spark.createDataFrame([(D(2024, 1, 1), "IDR", 5.0), (D(2024, 1, 2), "IDR", 5.0)],
                              "date date, currency string, usd_rate double")
    out = {(r["date"], r["usd_rate"], r["f"]) for r in rows(upsert.insert_if_missing(t, s, ["date", "currency"], "f"))}
    assert out == {(D(2024, 1, 1), 1.0, False), (D(2024, 1, 2), 5.0, True)}


def test_final_flag(spark):
    df = spark.createDataFrame([(D(2024, 1, 16),), (D(2024, 1, 17),)], "date_local date")
    assert [r["is_final"] for r in rows(upsert.final_flag(df, D(2024, 1, 30)), ["date_local"])] == [True, False]


# ------------------------------------------------------------------ KPIs and story
def _scan(spark, recs):
    cols = ("date_local date, market string, channel string, platform string, spend_usd double, impressions long, "
            "clicks long, ads_orders double, ads_gmv_usd double, direct_gmv_usd double, broad_gmv_usd double, "
            "platform_total_gmv_usd double, platform_total_orders long, tax_order int")
    return spark.createDataFrame(recs, cols)


def test_kpis_count_platform_totals_once(spark):
    d = D(2024, 1, 1)
    s = _scan(spark, [(d, "ID", "shopee_organic", "shopee", 0.0, 0, 0, 0.0, 0.0, None, None, 100.0, 10, 0),
                      (d, "ID", "meta_cpas", "shopee", 10.0, 5, 2, 1.0, 30.0, 30.0, 30.0, 100.0, 10, 10),
                      (d, "ID", "tiktok_ads", "tiktok_shop", 5.0, 5, 1, 1.0, 5.0, 5.0, 5.0, None, None, 9)])
    k = rows(metrics.kpis(s))[0]
    assert (k["spend"], k["gmv"], k["orders"], k["ads_gmv"]) == (15.0, 100.0, 10, 35.0)
    assert k["roas"] == pytest.approx(35 / 15)
    zero = rows(metrics.kpis(s.where("spend_usd = 0")))[0]
    assert zero["roas"] == 0.0


def test_week_split_needs_fourteen_dates(spark):
    recs = [(D(2024, 1, 1) + dt.timedelta(days=i), "ID", "meta_cpas", "shopee", 1.0, 1, 1, 1.0, 1.0, 1.0, 1.0,
             1.0, 1, 10) for i in range(13)]
    assert metrics.week_split(_scan(spark, recs)).count() == 0
    recs.append((D(2024, 1, 14), "ID", "meta_cpas", "shopee", 1.0, 1, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1, 10))
    w = rows(metrics.week_split(_scan(spark, recs)).groupBy("wk").count())
    assert {r["wk"]: r["count"] for r in w} == {"now": 7, "prev": 7}


def test_anomaly_rules_first_match_wins(spark):
    p = Params()
    d = spark.createDataFrame([("a", 2000.0, 0.3, 0.5), ("b", 500.0, -0.3, 0.5), ("c", 2000.0, None, -0.2),
                               ("d", 2000.0, 0.3, 0.0), ("e", 2000.0, 0.1, 0.1)],
                              "channel string, spend_now double, spend_delta double, roas_shift_pct double")
    lv = {r["channel"]: r["level"] for r in rows(metrics.anomaly_level(d, p))}
    assert lv == {"a": "data_issue", "b": "slump", "c": "slump", "d": "spike", "e": "healthy"}


def _deltas(spark, recs):
    return spark.createDataFrame(recs, "channel string, label string, tax_order int, spend_now double, "
                                       "spend_prev double, gmv_now double, gmv_prev double, roas_now double, "
                                       "roas_prev double, roas_shift double, roas_shift_pct double, "
                                       "spend_delta double")


def test_reallocation_rules(spark):
    p = Params()
    d = _deltas(spark, [
        ("google_ads_shopee", "G", 11, 10000.0, 9000.0, 0.0, 0.0, 4.0, 5.0, -1.0, -0.2, 0.11),
        ("shopee_ads_gmv_max", "S", 4, 20000.0, 20000.0, 0.0, 0.0, 3.0, 3.0, 0.0, 0.0, 0.0),
        ("shopee_ads_product_search", "P", 1, 20000.0, 1.0, 0.0, 0.0, 2.0, 2.0, 0.0, 0.0, 0.0),
        ("meta_cpas", "M", 10, 5000.0, 5000.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0),
        ("tiktok_ads", "T", 9, 4000.0, 4000.0, 0.0, 0.0, 6.0, 5.0, 1.0, 0.2, 0.0)])
    r = {x["rule"]: x for x in rows(decisions.reallocation(d, p))}
    assert (r[1]["action"], r[1]["dollars"], r[1]["impact"]) == ("cut", 1500.0, -2400.0)
    assert (r[2]["to_channel"], r[2]["dollars"], r[2]["impact"]) == ("shopee_ads_gmv_max", 2400.0, 7200.0)
    assert (r[3]["to_channel"], r[3]["dollars"], r[3]["impact"]) == ("tiktok_ads", 400.0, 2000.0)


def test_lever_contributions_sum_to_gmv_delta(spark):
    recs = []
    for i in range(14):
        now = i >= 7
        recs.append((D(2024, 1, 1) + dt.timedelta(days=i), "ID", "meta_cpas", "shopee", 1.0,
                     200 if now else 100, 20 if now else 15, 4.0 if now else 3.0, 50.0 if now else 30.0,
                     None, None, None, None, 10))
    s = _scan(spark, recs)
    lv = rows(decisions.lever_bridge(s, Params()))
    assert sum(r["contribution"] for r in lv) == pytest.approx(7 * 50.0 - 7 * 30.0)


def test_shares_sum_to_one_before_floor(spark):
    tax = seeds.channel_taxonomy(spark)
    d = D(2024, 1, 20)
    s = _scan(spark, [(d, "ID", c, "shopee", float(i + 1), 0, 0, 0.0, float(i), None, None, None, None, i)
                      for i, c in enumerate(seeds.PAID_CHANNELS)])
    sh = rows(metrics.share_divergence(s, tax, Params(share_floor=-1.0)))
    assert sum(r["spend_share"] for r in sh) == pytest.approx(1.0)
    assert sum(r["gmv_share"] for r in sh) == pytest.approx(1.0)


# ------------------------------------------------------------------ media response
def _panel(spark, spend, channel="meta_cpas", start=D(2024, 1, 1)):
    return spark.createDataFrame([(start + dt.timedelta(days=i), "ID", channel, s) for i, s in enumerate(spend)],
                                 "date_local date, market string, channel string, spend_usd double")


def _priors(spark, halflife):
    rec = list(seeds.CHANNEL_PRIORS[6])
    rec[1] = halflife
    return spark.createDataFrame([tuple(rec)], seeds.channel_priors(spark).schema)


@pytest.mark.parametrize("halflife", [0.0, 0.5, 7.0, 45.0, 400.0])
def test_adstock_is_the_closed_form_over_long_series(spark, halflife):
    """Seeded spend over 900 days with gaps, far beyond any default half-life."""
    import random
    rng = random.Random(17)
    spend = [round(rng.uniform(0, 500), 2) if rng.random() < 0.7 else None for _ in range(900)]
    spend[0], spend[-1] = 250.0, 80.0
    start = D(2021, 3, 1)
    panel = spark.createDataFrame([(start + dt.timedelta(days=i), "TH", "meta_cpas", s) for i, s in enumerate(spend) if s is not None],
                                  "date_local date, market string, channel string, spend_usd double")
    got = rows(response.adstock(panel, _priors(spark, halflife)), ["date_local"])
    decay = 0.5 ** (1 / halflife) if halflife > 0 else 0.0
    assert len(got) == 900 and got[0]["date_local"] == start
    for day in (0, 1, 13, 280, 281, 500, 899):
        want = sum((spend[i] or 0.0) * decay ** (day - i) for i in range(day + 1))
        assert got[day]["adstock"] == pytest.approx(want, rel=1e-9)


def test_adstock_keeps_series_apart_and_passes_unknown_channels(spark):
    panel = spark.createDataFrame([(D(2024, 5, d), m, c, float(10 * d)) for d in (1, 2) for m in ("TH", "PH")
                                   for c in ("meta_cpas", "tiktok_ads")],
                                  "date_local date, market string, channel string, spend_usd double")
    got = {(r["market"], r["channel"], r["date_local"].day): r["adstock"]
           for r in rows(response.adstock(panel, _priors(spark, 1.0)))}
    assert got["TH", "meta_cpas", 2] == got["PH", "meta_cpas", 2] == pytest.approx(25.0)
    assert got["TH", "tiktok_ads", 2] == pytest.approx(20.0)                  # no prior: passed through


def test_hill_matches_its_formula(spark):
    grid = [(x, e, s) for x in (-3.0, 0.0, 12.5, 640.0) for e in (40.0, 640.0) for s in (0.7, 1.9)]
    df = spark.createDataFrame(grid, "x double, e double, s double")
    for r in df.withColumn("y", response.hill(F.col("x"), F.col("e"), F.col("s"))).collect():
        x = max(r["x"], 0.0)
        assert r["y"] == pytest.approx(x ** r["s"] / (x ** r["s"] + r["e"] ** r["s"]))


def test_response_follows_adstock_and_saturation(spark):
    pr = seeds.channel_priors(spark).where("channel = 'meta_cpas'")
    prior = pr.first()
    decay = 0.5 ** (1 / prior["halflife"])
    spend = [300.0, 0.0, 900.0, 120.0]
    state, want = 0.0, []
    for s in spend:
        state = state * decay + s
        ec50 = prior["daily_spend"] / (1 - decay)
        sat = state ** prior["hill_shape"] / (state ** prior["hill_shape"] + ec50 ** prior["hill_shape"])
        want.append(sat * 2 * prior["baseline_roas"] * prior["daily_spend"])
    got = [r["response"] for r in rows(response.hill_response(_panel(spark, spend), pr), ["date_local"])]
    assert got == pytest.approx(want)


def test_seasonality_markets_and_payday(spark):
    days = spark.createDataFrame([(m, D(2024, 1, d)) for m in ("ID", "TH") for d in (2, 3, 15)],
                                 "market string, date_local date")
    ev = spark.createDataFrame([("fest", "festival", D(2024, 1, 3), D(2024, 1, 3), ["ID"], 1.5),
                                ("sale", "mega_sale", D(2024, 1, 2), D(2024, 1, 2), None, 2.0)],
                               "event_name string, event_kind string, start date, end date, "
                               "markets array<string>, uplift_mult double")
    m = {(r["market"], r["date_local"].day): r for r in rows(response.seasonality_multiplier(days, ev))}
    assert m[("ID", 3)]["event_mult"] == 1.5 and m[("TH", 3)]["event_mult"] == 1.0
    assert m[("ID", 2)]["event_mult"] == 2.0 and m[("TH", 2)]["event_mult"] == 2.0
    assert m[("TH", 15)]["multiplier"] == pytest.approx(0.95 * 1.25)        # Monday x payday
    # A seventh market takes part in events of all markets.
    seventh = spark.createDataFrame([("XX", D(2024, 1, 2)), ("XX", D(2024, 1, 3))], "market string, date_local date")
    x = {r["date_local"].day: r["event_mult"] for r in rows(response.seasonality_multiplier(seventh, ev))}
    assert x == {2: 2.0, 3: 1.0}


def test_seasonality_of_channels(spark):
    days = spark.createDataFrame([(m, c, D(2024, 1, 3)) for m in ("ID", "TH") for c in ("a", "b")],
                                 "market string, channel string, date_local date")
    ev = spark.createDataFrame([("x", "custom", D(2024, 1, 3), D(2024, 1, 3), None, 2.0, ["a"]),
                                ("y", "custom", D(2024, 1, 3), D(2024, 1, 3), ["ID"], 3.0, ["a"]),
                                ("z", "custom", D(2024, 1, 3), D(2024, 1, 3), ["ID"], 5.0, []),
                                ("w", "custom", D(2024, 1, 3), D(2024, 1, 3), [], 7.0, None)],
                               "event_name string, event_kind string, start date, end date, markets array<string>, "
                               "uplift_mult double, channels array<string>")
    m = {(r["market"], r["channel"]): r["event_mult"] for r in rows(response.seasonality_multiplier(days, ev))}
    assert m == {("ID", "a"): 210.0, ("ID", "b"): 35.0, ("TH", "a"): 14.0, ("TH", "b"): 7.0}
    by_market = rows(response.seasonality_multiplier(days.drop("channel"), ev))
    assert {r["market"]: r["event_mult"] for r in by_market} == {"ID": 35.0, "TH": 7.0}


def test_gmv_cap_bounds_ads(spark):
    p = spark.createDataFrame([(D(2024, 1, 1), "ID", c, "shopee", g, 100.0) for c, g in (("a", 80.0), ("b", 40.0))],
                              "date_local date, market string, channel string, platform string, "
                              "ads_attributed_gmv_usd double, platform_total_gmv_usd double")
    out = rows(response.gmv_cap(p))
    assert sum(r["capped_gmv_usd"] for r in out) == pytest.approx(95.0)
    assert out[0]["organic_gmv_usd"] == pytest.approx(5.0)


def test_what_if_patches(spark):
    r = spark.createDataFrame([(D(2024, 1, 1), "ID", "tiktok_ads", 1.0, 10, 100, 1.0, 5.0)],
                              "date_local date, market string, channel string, spend_usd double, impressions long, "
                              "clicks long, ads_orders double, ads_gmv_usd double")
    out = rows(response.what_if(r, response.scenario_patches(spark, "algo_change")))[0]
    assert out["clicks"] == pytest.approx(70.0) and out["spend_usd"] == 1.0
    assert rows(r)[0]["clicks"] == 100
    with pytest.raises(KeyError):
        response.scenario_patches(spark, "nope")
    kinds = "seq long, channel string, metric string, op string, value double"

    def apply(*patches):
        return rows(response.what_if(r, spark.createDataFrame([(i, *p) for i, p in enumerate(patches)], kinds)))[0]
    assert apply(("tiktok_ads", "clicks", "mul", 2.0), ("tiktok_ads", "clicks", "add", 5.0))["clicks"] == 205.0
    assert apply(("tiktok_ads", "clicks", "add", 5.0), ("tiktok_ads", "clicks", "mul", 2.0))["clicks"] == 210.0
    assert apply(("tiktok_ads", "clicks", "mul", 2.0), ("tiktok_ads", "clicks", "set", 1.0))["clicks"] == 1.0
    for bad in (("tiktok_ads", "ctr", "mul", 0.7), ("tiktok_ads", "clicks", "divide", 2.0), ("nowhere", "clicks", "mul", 2.0),
                ("tiktok_ads", "clicks", "mul", None)):
        with pytest.raises(Exception, match="what-if"):
            apply(bad)


def test_modelled_evc_bounded(spark):
    p = spark.createDataFrame([(D(2024, 1, 1), "ID", "tiktok_ads", 3), (D(2024, 1, 1), "ID", "meta_cpas", 0),
                               (D(2024, 1, 1), "ID", "shopee_ads_gmv_max", 7)],
                              "date_local date, market string, channel string, ads_attributed_orders long")
    for r in rows(response.modelled_evc(p, seeds.channel_priors(spark))):
        assert 0 <= r["evc_conversions"] <= r["all_conversions"]
        if r["channel"] == "shopee_ads_gmv_max":
            assert (r["all_conversions"], r["evc_conversions"]) == (7.0, 0.0)
        if r["channel"] == "tiktok_ads":
            assert r["all_conversions"] == 4.0                                  # bround(3 / 0.75)


# ------------------------------------------------------------------ IO
def test_envelope_shapes(spark):
    two_d = json.dumps({"data": [["Date", "Spend"], ["2024-01-01", "1.5"], ["2024-01-02", "x"]]})
    objs = json.dumps({"data": [{"Date": "2024-01-03", "Spend": "2"}]})
    land = spark.createDataFrame([(two_d,), (objs,), ("{}",), (json.dumps({"data": []}),)], "body string")
    rec = io.flatten_envelope(land)
    typed = rows(io.typed_records(rec, schemas.TIKTOK_ADS_DAILY.__class__(
        [f for f in schemas.TIKTOK_ADS_DAILY.fields if f.name in ("Date", "Spend")])), ["Date"])
    assert [(r["Date"], None if r["Spend"] is None else float(r["Spend"])) for r in typed] == \
        [(D(2024, 1, 1), 1.5), (D(2024, 1, 2), None), (D(2024, 1, 3), 2.0)]


def test_ndjson_load_ignores_unknown_and_blank(spark, tmp_path):
    p = tmp_path / "x.ndjson"
    p.write_text('{"Date": "2024-01-01", "Spend": 3.5, "Bogus": 1}\n\n{"Date": "2024-01-02"}\n')
    df = io.load_ndjson(spark, str(p), schemas.TIKTOK_ADS_DAILY, dt.datetime(2024, 1, 5))
    out = rows(df, ["Date"])
    assert len(out) == 2 and "Bogus" not in df.columns
    assert all(r["ingested_at"] == dt.datetime(2024, 1, 5) for r in out)
    empty = spark.createDataFrame([], schemas.TIKTOK_ADS_DAILY)
    assert io.append_bronze(empty, str(tmp_path / "b")) == 0
    assert io.append_bronze(df, str(tmp_path / "b")) == 2
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2


def test_broken_lines_fail_or_go_to_quarantine(spark, tmp_path):
    p = tmp_path / "x.ndjson"
    p.write_text('{"Date": "2024-01-01", "Spend": 3.5}\n{"Date": "2024-01-\n{"Spend": "many"}\n')
    with pytest.raises(Exception):
        io.load_ndjson(spark, str(p), schemas.TIKTOK_ADS_DAILY, dt.datetime(2024, 1, 5)).collect()
    good, bad = io.load_ndjson_with_rejects(spark, str(p), schemas.TIKTOK_ADS_DAILY, dt.datetime(2024, 1, 5))
    assert [float(r["Spend"]) for r in rows(good)] == [3.5]
    assert sorted(r["line"] for r in rows(bad)) == ['{"Date": "2024-01-', '{"Spend": "many"}']


def test_filters_and_csv_order(spark):
    df = spark.createDataFrame([("SHP_a", "x"), ("b", "y")], "Campaign_name string, _market string")
    f = io.compile_filters([{"field": "Campaign_name", "op": "STARTS_WITH", "value": "SHP_"},
                            {"field": "_market", "op": "IN_LIST", "value": ["x", "z"]}])
    assert df.where(f).count() == 1
    with pytest.raises(ValueError):
        io.compile_filters([{"field": "a", "op": "REGEX", "value": "x"}])
    assert io.csv_columns(df.withColumn("extra", F.lit(1)), ["Campaign_name"]) == ["Campaign_name", "_market",
                                                                                    "extra"]


# ------------------------------------------------------------------ data quality
def test_dq_checks_catch_seeded_violations(spark):
    d = D(2024, 1, 1)
    panel = spark.createDataFrame(
        [(d, "ID", "meta_cpas", "shopee", 10.0, 5, 10, 1, 200.0, 50.0, 40.0, 100.0, False),
         (d, "ID", "mystery", "shopee", -1.0, 1, 1, 1, 1.0, 1.0, 1.0, 100.0, True),
         (None, "ID", "x_other", "shopee", 0.0, 1, 1, 1, 1.0, 1.0, 1.0, 100.0, False)],
        "date_local date, market string, channel string, platform string, spend_usd double, impressions long, "
        "clicks long, ads_attributed_orders long, ads_attributed_gmv_usd double, direct_gmv_usd double, "
        "broad_gmv_usd double, platform_total_gmv_usd double, is_mega_sale boolean")
    tax = seeds.channel_taxonomy(spark)
    assert quality.q02_ads_gmv_bounded(panel).count() == 1
    assert panel.where(quality.no_negative()).count() == 1
    assert panel.where(quality.funnel_monotone()).count() == 1
    assert quality.q06_every_market(panel, seeds.dim_market(spark)).count() == 5
    assert panel.where(quality.grain_null()).count() == 1
    assert [r[0] for r in quality.q08_channel_in_taxonomy(panel, tax).collect()] == ["mystery"]
    cal = spark.createDataFrame([(d, "ID", "e", "mega_sale")], "date date, market string, event_name string, "
                                                                "event_kind string")
    assert quality.q11_mega_sale_flag(panel, cal).count() == 1
    assert panel.where(quality.direct_leq_broad_gmv()).count() == 1
    negative = quality.RowCheck("panel", lambda: panel, quality.no_negative())
    nulls = quality.RowCheck("panel", lambda: panel, quality.grain_null())
    good = {"neg": negative, "null": nulls, "ok": lambda: panel.where("false")}
    suite = {r["check"]: (r["status"], r["rows"]) for r in rows(quality.dq_suite(spark, good))}
    assert suite == {"neg": ("FAIL", 1), "null": ("FAIL", 1), "ok": ("PASS", 0)}
    # One check that cannot be planned, one that fails while it runs.
    run_time = quality.RowCheck("panel", lambda: panel, F.col("channel").cast("int") > 0)
    broken = good | {"broken": lambda: panel.select("no_such_column"), "run_time": run_time}
    suite = {r["check"]: (r["status"], r["rows"]) for r in rows(quality.dq_suite(spark, broken))}
    assert suite == {"neg": ("FAIL", 1), "null": ("FAIL", 1), "ok": ("PASS", 0), "broken": ("ERROR", -1), "run_time": ("ERROR", -1)}
    assert quality.suite_exit_status(quality.dq_suite(spark, {"ok": lambda: panel.where("false")})) == 0
    assert quality.suite_exit_status(quality.dq_suite(spark, {"neg": negative})) == 1


def test_spines_follow_the_dimensions(spark):
    """A seventh market and a channel outside the taxonomy keep their rows."""
    tax = seeds.channel_taxonomy(spark)
    dim = seeds.dim_market(spark).unionByName(spark.createDataFrame(
        [("XX", "New", "UTC", "USD")], "market string, country_name string, timezone string, currency string"))
    d = D(2024, 1, 20)
    s = _scan(spark, [(d, "XX", "shopee_ads_other", "shopee", 900.0, 1, 1, 1.0, 50.0, None, None, 70.0, 3, 0),
                      (d, "ID", "meta_cpas", "shopee", 5.0, 1, 1, 1.0, 50.0, None, None, 70.0, 3, 1)])
    p = Params(as_of=d, focus_channel="shopee_ads_other")
    top = rows(metrics.top_channel_stack(s, tax, p))
    assert [(r["channel"], r["spend"]) for r in top if r["rank"] == 1] == [("shopee_ads_other", 900.0)]
    assert {r["market"]: r["gmv"] for r in rows(metrics.market_trend(s, dim, p))}["XX"] == 70.0
    assert {r["market"]: r["value"] for r in rows(metrics.heatmap(s, dim, p))}["XX"] == 900.0
    grid = {(r["channel"], r["market"]): r["spend"] for r in rows(metrics.channel_market_grid(s, tax, dim, p))}
    assert grid["shopee_ads_other", "XX"] == 900.0 and len(grid) == 7 * (len(seeds.PAID_CHANNELS) + 1)
    panel = spark.createDataFrame([(d, "XX", "shopee_ads_other", "shopee", 900.0, 30, 70.0, False, False, False, 13)],
                                  "date_local date, market string, channel string, platform string, spend_usd double, "
                                  "impressions long, platform_total_gmv_usd double, is_weekend boolean, is_payday boolean, "
                                  "is_mega_sale boolean, week_of_year int")
    frame = rows(features.regression_frame(panel))[0]
    assert frame["week_of_year"] == 13 and frame["i_other"] == pytest.approx(math.log1p(30)) and frame["i_meta_cpas"] == 0
    assert frame["market"] == "XX" and frame["x_other"] == pytest.approx(math.log1p(900.0))


def test_period_compare_reaches_back_two_windows(spark):
    tax, as_of = seeds.channel_taxonomy(spark), D(2024, 3, 31)
    panel = spark.createDataFrame([(as_of - dt.timedelta(days=i), "ID", "meta_cpas", "shopee", 1.0, 0, 0, 0, 0.0, 0.0, 0.0, 1, 1.0, False, False, False)
                                   for i in range(80)],
                                  "date_local date, market string, channel string, platform string, spend_usd double, impressions long, "
                                  "clicks long, ads_attributed_orders long, ads_attributed_gmv_usd double, direct_gmv_usd double, "
                                  "broad_gmv_usd double, platform_total_orders long, platform_total_gmv_usd double, is_weekend boolean, "
                                  "is_payday boolean, is_mega_sale boolean")
    for n in (14, 20, 30):
        p = Params(as_of=as_of, range_days=n)
        got = {r["period"]: r["spend"] for r in rows(metrics.period_compare(metrics.scan_panel(panel, tax, p), p))}
        assert got == {"now": float(n), "prev": float(n)}


def test_fact_keys_take_the_latest_attributes(spark):
    """Two objectives on one key give one row, with the attributes of the
    latest one; equal moments are broken by the attributes themselves."""
    from mediapanel.operators import facts
    d, t = D(2024, 1, 5), dt.datetime(2024, 1, 6)
    base = dict(zip(facts.ONPLATFORM_KEY, (d, "ID", "tiktok_ads", "other", "c", None, None)))
    sums = ["spend_local", "spend_usd", "impressions", "clicks", "video_views_2s_or_6s", "direct_orders", "broad_orders",
            "direct_gmv_local", "broad_gmv_local", "direct_gmv_usd", "broad_gmv_usd"]
    data = [{**base, **{c: 1.0 for c in sums}, "objective": o, "attribution_window": w, "currency": "IDR", "ingested_at": at}
            for o, w, at in (("TRAFFIC", "7d", t), ("REACH", "1d", t + dt.timedelta(hours=1)), ("REACH", "9d", t + dt.timedelta(hours=1)))]
    stg = spark.createDataFrame(data, "date_local date, market string, platform string, ad_type string, campaign_id string, "
                                "ad_group_id string, sku_id string, objective string, attribution_window string, currency string, "
                                "ingested_at timestamp, " + ", ".join(f"{c} double" for c in sums))
    got = rows(facts.fact_onplatform_ads(stg, D(2024, 1, 30)))
    assert len(got) == 1 and (got[0]["objective"], got[0]["attribution_window"], got[0]["clicks"]) == ("REACH", "9d", 3.0)


def test_partition_count_invariance(spark):
    """Dedup ties and aggregation results do not depend on the partitioning
    (exactly for the staged rows; double sums to a relative 1e-12, since the
    summation order changes their last bits)."""
    import math

    from mediapanel.plans.chain import Chain
    from .conftest import SMALL
    old = spark.conf.get("spark.sql.shuffle.partitions")
    stg, panel = [], []
    try:
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            c = Chain(spark, SMALL, cache_marts=False)
            s = c.stg_platform_sales.drop("create_time_utc", "pay_time_utc", "complete_time_utc")
            stg.append(sorted(map(tuple, s.collect()), key=str))
            p = c.panel.drop("event_kinds")
            panel.append({(r["date_local"], r["market"], r["channel"]): r for r in p.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert stg[0] == stg[1]
    assert panel[0].keys() == panel[1].keys()
    for k, a in panel[0].items():
        b = panel[1][k]
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12), (k, x, y)
            else:
                assert x == y, (k, x, y)


def test_adstock_over_ten_thousand_days(spark):
    """The scan over blocks equals the recursion step by step, in one series of
    27 years with gaps and in one that begins and ends inside a block."""
    import random
    from mediapanel.operators import response
    rng = random.Random(5)
    first = dt.date(1990, 3, 5)
    spend = {("ID", "meta_cpas"): {d: rng.random() * 100 for d in range(10_000) if rng.random() < 0.7},
             ("SG", "tiktok_ads"): {d: float(d) for d in range(100, 230)}}
    spend["ID", "meta_cpas"][0] = spend["ID", "meta_cpas"][9_999] = 1.0
    rows = [(m, c, first + dt.timedelta(d), v) for (m, c), days in spend.items() for d, v in days.items()]
    panel = spark.createDataFrame(rows, "market string, channel string, date_local date, spend_usd double")
    for halflife in (0.0, 0.5, 7.0, 400.0):
        priors = spark.createDataFrame([(c, halflife) for c in ("meta_cpas", "tiktok_ads")], "channel string, halflife double")
        out = response.adstock(panel, priors)
        got = {(r.market, (r.date_local - first).days): r.adstock for r in out.collect()}
        decay = 0.5 ** (1 / halflife) if halflife else 0.0
        for (market, _), days in spend.items():
            held = 0.0
            for d in range(min(days), max(days) + 1):
                held = days.get(d, 0.0) + decay * held
                assert got[market, d] == pytest.approx(held, rel=1e-9)
        assert len(got) == 10_000 + 130
    plan = out._jdf.queryExecution().toString()
    assert "aggregate(" not in plan and "collect_list" not in plan


def test_sales_fact_has_one_row_per_key_with_several_currencies(spark):
    from mediapanel.operators import facts
    from mediapanel.sources import bind
    day, at = dt.date(2024, 1, 5), dt.datetime(2024, 1, 6)
    rows = [(day, "ID", "shopee", "s", "k", cur, src, gmv, off, at + dt.timedelta(hours=h))
            for cur, src, gmv, off, h in (("IDR", "ads", 1000.0, False, 1), ("SGD", "ads", 2.0, False, 3), ("IDR", None, 500.0, True, 2),
                                          ("SGD", "live", 3.0, False, 0))]
    rows += [(day, "ID", "shopee", "s", "other", "IDR", "ads", 7.0, False, at), (day, "ID", "shopee", "s", "norate", "XXX", "ads", 7.0, False, at)]
    stg = spark.createDataFrame(rows, "date_local date, market string, platform string, shop_id string, sku_id string, currency string, "
                                "traffic_source string, gmv double, is_cancelled boolean, ingested_at timestamp")
    stg = stg.withColumn("gmv_local", F.col("gmv").cast("decimal(18,4)"))
    fx = bind.test_fx(spark)
    rate = {r.currency: float(r.usd_rate) for r in fx.where(F.col("date") == F.lit(day)).collect()}
    got = {r.sku_id: r for r in facts.fact_platform_sales(stg, fx, dt.date(2024, 1, 30)).collect()}
    assert len(got) == 3
    r = got["k"]
    assert (r.currency, r.orders_gross, r.orders_cancelled, r.orders_net) == ("SGD", 4, 1, 3)
    assert r.gmv_net_usd == pytest.approx(5 / rate["SGD"] + 1000 / rate["IDR"])
    assert float(r.gmv_net_local) == pytest.approx(5 + 1000 / rate["IDR"] * rate["SGD"], abs=1e-4)
    assert float(r.gmv_gross_local) == pytest.approx(5 + 1500 / rate["IDR"] * rate["SGD"], abs=1e-4)
    assert [(m.traffic_source, m.cnt) for m in r.traffic_source_mix] == [(None, 1), ("ads", 2), ("live", 1)]
    assert got["other"].currency == "IDR" and float(got["other"].gmv_net_local) == 7.0
    assert got["norate"].gmv_net_usd is None and float(got["norate"].gmv_net_local) == 7.0
