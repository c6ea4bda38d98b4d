"""Published snapshots: one switch, refreshes that stop half way, touched days,
metadata without a scan."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mediapanel.operators.publish import Conflict, Snapshots
from mediapanel.plans.chain import Chain
from mediapanel.sources import bind

from .conftest import SMALL

DAY = {f: "date" if f.startswith("evc_") else "Date" for f in bind.RAW_BUILDERS}
D = dt.date


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()), key=str)


def state(store):
    return {n: rows_of(store.read(n)) for n in store.manifest()["tables"]}


def frame(spark, rows):
    return spark.createDataFrame(rows, "date_local date, market string, channel string, v long")


def test_readers_see_all_tables_of_a_version_or_none(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.versions() == [] and store.manifest()["tables"] == {}
    first = store.draft()
    first.write("a", frame(spark, [(D(2024, 1, 1), "ID", "x", 1), (D(2024, 1, 2), "SG", "y", 2), (None, "SG", "y", 3)]))
    first.write("b", frame(spark, [(D(2024, 1, 1), "ID", "x", 1)]))
    assert store.versions() == []                                        # nothing is published yet
    assert first.publish() == 1
    before = state(store)
    meta = store.meta("a").first()
    assert tuple(meta) == (D(2024, 1, 1), D(2024, 1, 2), 2, "ID,SG", "x,y")
    # A draft that stops between two writes changes nothing.
    lost = store.draft()
    lost.write("a", frame(spark, [(D(2024, 1, 2), "SG", "y", 20), (D(2024, 1, 3), "SG", "y", 30)]))
    assert state(store) == before and Snapshots(spark, str(tmp_path)).versions() == [1]
    # The next one replaces day 2, empties day 1 and adds day 4.
    draft = store.draft()
    draft.write("a", frame(spark, [(D(2024, 1, 2), "MY", "z", 5), (D(2024, 1, 4), "MY", "z", 6)]), [D(2024, 1, 1)])
    assert rows_of(draft.read("a")) == rows_of(frame(spark, [(D(2024, 1, 2), "MY", "z", 5), (D(2024, 1, 4), "MY", "z", 6)]))
    assert state(store) == before
    draft.publish()
    assert state(store)["b"] == before["b"] and store.read("a").count() == 2
    assert store.read("a", [D(2024, 1, 4), D(2030, 1, 1)]).count() == 1 and store.read("a", []).count() == 0
    # The one that was lost comes too late: its version is taken.
    with pytest.raises(Conflict):
        lost.publish()
    assert rows_of(store.read("a", manifest=store.manifest(1))) == before["a"]
    assert store.vacuum(keep=1) > 0
    assert store.versions() == [2] and store.read("a").count() == 2 and store.read("b").count() == 1
    assert store.vacuum(keep=1) == 0


def test_refresh_of_touched_days(spark, tmp_path, monkeypatch):
    whole = Chain(spark, SMALL, cache_marts=False)
    whole.land_bronze(str(tmp_path / "bronze"))
    cut = dt.datetime(2024, 1, 20)
    old = Chain(spark, SMALL, cache_marts=False)
    old.raw = whole.raw.with_feeds(**{f: whole.raw[f].where(F.col("ingested_at") < F.lit(cut)) for f in bind.RAW_BUILDERS})
    store = old.publish(str(tmp_path / "store"))
    before, first = state(store), store.manifest()

    # Lost after the second fact: the first version stays whole.
    from mediapanel.operators import publish as module
    write, seen = module.Draft.write, []

    def failing(self, name, *args, **kw):
        if len(seen) == 2:
            raise RuntimeError("driver lost")
        seen.append(name)
        return write(self, name, *args, **kw)
    monkeypatch.setattr(module.Draft, "write", failing)
    with pytest.raises(RuntimeError, match="driver lost"):
        whole.refresh_published(store)
    assert seen and store.versions() == [1] and state(store) == before
    monkeypatch.setattr(module.Draft, "write", write)

    assert whole.refresh_published(store, replace_days=True) == 2
    for name in Chain.MATERIALIZED:
        assert rows_of(store.read(name)) == rows_of(getattr(whole, name)), name
    # Days without new rows keep their snapshot.
    touched = whole.touched_days(dt.datetime.fromisoformat(first["mark"]))
    now = store.manifest()
    for name in ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads", "fact_evc"):
        days = {d.isoformat() for d in touched[name]}
        kept = {d for d, e in now["tables"][name]["days"].items() if e["snap"] == first["tables"][name]["days"].get(d, {}).get("snap")}
        assert kept == set(now["tables"][name]["days"]) - days
    assert any(e["snap"].startswith("v0000000001") for t in now["tables"].values() for e in t["days"].values())
    assert whole.refresh_published(store) is None


def test_keys_that_only_the_target_has_stay(spark, tmp_path):
    """A campaign that the provider no longer reports."""
    whole = Chain(spark, SMALL, cache_marts=False)
    cut = dt.datetime(2024, 1, 20)
    old = Chain(spark, SMALL, cache_marts=False)
    old.raw = whole.raw.with_feeds(**{f: whole.raw[f].where(F.col("ingested_at") < F.lit(cut)) for f in bind.RAW_BUILDERS})
    touched = whole.touched_days(cut)["fact_onplatform_ads"]
    gone_id = (old.fact_onplatform_ads.where(F.col("date_local").isin(touched)).groupBy("campaign_id").count()
               .orderBy(F.desc("count"), "campaign_id").first()[0])
    new = Chain(spark, SMALL, cache_marts=False)
    new.raw = whole.raw.with_feeds(**{f: whole.raw[f].where(F.col("Campaign_id") != gone_id)
                                      for f in ("shopee_ads_daily", "tiktok_ads_daily")})
    for replace_days in (False, True):
        store = old.publish(str(tmp_path / str(replace_days)))
        days = new.touched_days(dt.datetime.fromisoformat(store.manifest()["mark"]))["fact_onplatform_ads"]
        gone = lambda: store.read("fact_onplatform_ads", days).where(F.col("campaign_id") == gone_id).count()
        had = gone()
        new.refresh_published(store, replace_days)
        assert had > 0 and gone() == (0 if replace_days else had)


def test_meta_has_no_scan(spark):
    plan = Chain(spark, SMALL).published.meta("panel")._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "parquet" not in plan.lower()


def test_facts_are_published_from_the_ranges_they_are_built_in(spark, tmp_path, monkeypatch):
    """First load and refresh: no shuffle by day between a sales or ads fact and
    its snapshot, and no shuffle files left behind."""
    from pyspark.sql.classic.dataframe import DataFrame
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {b for b in blocks.getAllBlocks().mkString(",").split(",") if b.startswith("shuffle_")}
    whole = Chain(spark, SMALL, cache_marts=False)
    whole.land_bronze(str(tmp_path / "bronze"))
    cut = dt.datetime(2024, 1, 20)
    old = Chain(spark, SMALL, cache_marts=False)
    old.raw = whole.raw.with_feeds(**{f: whole.raw[f].where(F.col("ingested_at") < F.lit(cut)) for f in bind.RAW_BUILDERS})
    moved, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, name, *a: (moved.append(set(self.columns)) if name == "rebalance" else None)
                        or hint(self, name, *a))
    small = ({"attribution_bucket"}, {"is_mega_sale"})      # conversions and marts: bounded by the calendar
    before = held()
    store = old.publish(str(tmp_path / "store"))
    assert len(moved) == 3 and all(any(x <= columns for x in small) for columns in moved)
    assert whole.refresh_published(store, replace_days=True) == 2
    assert len(moved) == 6 and all(any(x <= columns for x in small) for columns in moved)
    # What is left are the few rows that were read back to count and to compare.
    tables = sum(f.stat().st_size for f in (tmp_path / "store").rglob("*.parquet"))
    left = sum(blocks.getFile(b).length() for b in held() - before)
    assert left < tables / 4
