"""What the queries move: sorts, shuffles and readings of the order lines."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from mediapanel.operators import conform, facts
from mediapanel.plans.chain import Chain
from mediapanel.plans.registry import QUERIES
from mediapanel.session import INITIAL_PARTITIONS, SHUFFLE_CLEANUP, size_shuffles
from mediapanel.sources import bind
from mediapanel.sources.schemas import RAW_SCHEMAS

from .conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange hashpartitioning", plan))


def test_sales_fact_shuffles_the_staged_rows_once(spark):
    c = Chain(spark, SMALL, cache_marts=False)
    stg = c.stg_platform_sales
    assert exchanges(plan_of(c.fact_platform_sales)) == exchanges(plan_of(stg)) + 1
    few = c.fact_platform_sales.select("date_local", "orders_net", "gmv_net_usd")
    assert "collect_list" not in plan_of(few)


def test_sales_fact_without_rate_or_amount(spark):
    """USD is NULL where one of a key's currencies has no rate or no amount."""
    import datetime as dt
    day, at = dt.date(2024, 1, 5), dt.datetime(2024, 1, 6)
    rows = [(day, "SG", "shopee", "s", k, cur, src, gmv, False, at) for k, cur, src, gmv in (
        ("part", "SGD", "ads", None), ("part", "SGD", "live", 2.0), ("none", "SGD", "ads", None),
        ("mixed", "SGD", "ads", 2.0), ("mixed", "XXX", "ads", 2.0))]
    stg = spark.createDataFrame(rows, "date_local date, market string, platform string, shop_id string, sku_id string, currency string, "
                                "traffic_source string, gmv double, is_cancelled boolean, ingested_at timestamp")
    stg = stg.withColumn("gmv_local", F.col("gmv").cast("decimal(18,4)"))
    got = {r.sku_id: r for r in facts.fact_platform_sales(stg, bind.test_fx(spark), dt.date(2024, 1, 30)).collect()}
    assert float(got["part"].gmv_net_local) == 2.0 and got["part"].gmv_net_usd > 0
    assert got["none"].gmv_net_usd is None and got["none"].gmv_net_local is None
    assert got["mixed"].gmv_net_usd is None and [m.cnt for m in got["mixed"].traffic_source_mix] == [2]


def test_panel_reads_the_sales_fact_once(spark):
    plan = Chain(spark, SMALL, cache_marts=False).panel._jdf.queryExecution().optimizedPlan().toString()
    totals = re.findall(r"Aggregate \[date_local#\d+, market#\d+, platform#\d+\], \[[^\n]*", plan)
    shape = {re.sub(r"#\d+L?", "", t) for t in totals}
    assert len(totals) == 2 and all("platform_total_gmv_usd" in t for t in totals), shape


def test_order_lines_are_joined_without_a_sort(spark):
    plan = plan_of(bind.order_base(spark, SMALL))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_shuffles_start_from_as_many_partitions_as_the_input_needs(spark, monkeypatch):
    from mediapanel import session
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(INITIAL_PARTITIONS)
        paths = [f"{SMALL}/{t}.parquet" for t in bind.TABLES]
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert size_shuffles(spark, paths) == least                     # never fewer than the session has
        monkeypatch.setattr(session, "INPUT_PER_PARTITION", 1000)
        many = size_shuffles(spark, paths)
        assert many > 100 and int(spark.conf.get(INITIAL_PARTITIONS)) == many
        assert size_shuffles(spark, []) == many                          # nor lowered by a smaller input
        assert size_shuffles(spark, [f"{SMALL}/missing.parquet"]) == many
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)


def test_snapshots_are_published_without_landing_or_a_second_copy(spark):
    c = Chain(spark, SMALL)
    assert QUERIES["panel_meta"](c).first()["row_count"] == c.panel.count()
    assert "landed" not in c.__dict__ and "stored" not in c.__dict__
    assert set(c.published.manifest()["tables"]) == set(Chain.MATERIALIZED)


def test_landing_keeps_no_feed_in_memory(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)
    Chain(spark, SMALL).land_bronze(str(tmp_path))
    assert not kept


def test_spines_write_nothing(spark):
    c = Chain(spark, SMALL)
    assert QUERIES["fx_spine"](c).count() and QUERIES["calendar_spine"](c).count()
    assert "landed" not in c.__dict__ and "stored" not in c.__dict__


def test_published_refresh_starts_from_the_landed_feeds_alone(spark):
    c = Chain(spark, SMALL)
    assert QUERIES["published_refresh"](c).count()
    assert "landed" in c.__dict__ and "stored" not in c.__dict__


def test_daily_refresh_reads_the_first_load_once(spark):
    plan = QUERIES["daily_refresh"](Chain(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    # Sales totals stand twice in a panel plan (J5, organic rows), the second load
    # twice in an upsert; each reads two order feeds. The first load: once.
    assert len(re.findall(r"Relation \[l_orderkey", plan)) == 2 * 2 * (1 + 2)


def test_landing_shuffles_the_narrow_rows(spark):
    """Wide fields of a feed are derived after its rows were clustered by day,
    and the writer finds them sorted."""
    for name in bind.RAW_BUILDERS:
        df = bind.landing_feed(spark, SMALL, name)
        assert df.columns == [f.name for f in RAW_SCHEMAS[name].fields] + ["ingest_date"]
        above, below = df._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
        assert "concat(" in above and "Sort [ingest_date" in above
        assert "concat(" not in below and "_source_system" not in below
        fresh = bind.RAW_BUILDERS[name](spark, SMALL)
        assert df.drop("ingest_date").exceptAll(fresh).isEmpty() and fresh.exceptAll(df.drop("ingest_date")).isEmpty()
    assert df.where("ingest_date <> to_date(ingested_at)").isEmpty()


def test_facts_are_written_from_the_ranges_they_are_built_in(spark, tmp_path, monkeypatch):
    """No shuffle by day between a fact and its folders; no row is changed."""
    from pyspark.sql.classic.dataframe import DataFrame
    c = Chain(spark, SMALL, cache_marts=False)
    written, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, name, *a: (written.append(self.columns) if name == "rebalance" else None)
                        or hint(self, name, *a))
    facts_ = ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads")
    c.materialize(str(tmp_path), names=facts_)
    assert not written
    lazy = Chain(spark, SMALL, cache_marts=False)
    for n in facts_:
        a, b = ([r.asDict(recursive=True) for r in x.select(*sorted(x.columns)).collect()] for x in (getattr(c, n), getattr(lazy, n)))
        same = lambda rows: sorted(str({k: round(v, 6) if isinstance(v, float) else v for k, v in r.items()}) for r in rows)
        assert same(a) == same(b), n
        ranges = plan_of(lazy.in_day_ranges(n))
        assert "rangepartitioning(date_local" in ranges
    # One range of days a task: as few files as tasks and days.
    assert len(list((tmp_path / "fact_platform_sales").rglob("*.parquet"))) < 2 * 31


def test_sales_fact_moves_no_tie_breaker_that_cannot_change_it(spark):
    plan = Chain(spark, SMALL, cache_marts=False).fact_platform_sales._jdf.queryExecution().optimizedPlan().toString()
    assert "INTERVAL '03 " not in plan and "complete_time_utc" not in plan and "pay_time_utc" not in plan
    order = ["at", "item", "shop", "gmv", "paid", "done"]
    assert conform.deciding(order, ["k"], ["k", "at", "shop"]) == ["at", "item", "shop"]
    assert conform.deciding(order, ["k"], ["k"]) == ["at"] and conform.deciding(order, ["k"], order) == order
    rows = [("a", 1, 5, 7, i % 2, i) for i in range(4)] + [("b", 2, i, 8 - i, 1, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, at long, item long, shop long, paid long, done long")
    full = conform.latest_wins(df, ["k"], ["at", "item", "shop", "paid", "done"]).select("k", "at", "shop")
    few = conform.latest_wins(df, ["k"], conform.deciding(["at", "item", "shop", "paid", "done"], ["k"], ["at", "shop"]))
    assert sorted(full.collect()) == sorted(few.select("k", "at", "shop").collect())


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark.conf.unset(SHUFFLE_CLEANUP)
    held = lambda: {b for b in blocks.getAllBlocks().mkString(",").split(",") if b.startswith("shuffle_")}
    c = Chain(spark, SMALL, cache_marts=False)
    before = held()
    c.land_bronze(str(tmp_path / "b"))
    c.materialize(str(tmp_path / "t"), names=("fact_platform_sales", "fact_onplatform_ads"))
    assert not held() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
