"""Stage order seeds -> staging -> facts -> mart -> EVC, as lazy DataFrames.

``Chain`` builds each stage once per (session, data directory, params) and
hands out the same DataFrame objects, so a query that needs the panel and
the facts shares one logical plan instead of re-deriving it.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Params
from ..operators import conform, facts, panel
from ..session import ensure_checkpoint_dir, shuffles_dropped, size_shuffles
from ..sources import bind, seeds


def _run_parallel(fn, items, parallelism: int):
    """Run independent Spark jobs from a few driver threads; results in order."""
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return list(ex.map(fn, items))


class Chain:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT, cache_marts: bool = True):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params
        self.cache_marts = cache_marts
        self.raw = bind.Bronze(spark, sf_dir)
        size_shuffles(spark, [f"{sf_dir}/{t}.parquet" for t in bind.TABLES])
        self._kept: list[DataFrame] = []  # persisted frames

    # -- seeds ---------------------------------------------------------------
    @cached_property
    def dim_market(self) -> DataFrame:
        return seeds.dim_market(self.spark)

    @cached_property
    def fx(self) -> DataFrame:
        return bind.test_fx(self.spark)

    @cached_property
    def calendar(self) -> DataFrame:
        return bind.test_calendar(self.spark)

    @cached_property
    def taxonomy(self) -> DataFrame:
        return seeds.channel_taxonomy(self.spark)

    @cached_property
    def traffic_map(self) -> DataFrame:
        return seeds.traffic_source_map(self.spark)

    @cached_property
    def priors(self) -> DataFrame:
        return seeds.channel_priors(self.spark)

    # -- staging -------------------------------------------------------------
    def bronze(self, name: str) -> DataFrame:
        """A raw feed; with a refresh window and a landed (ingest-day
        partitioned) table, only partitions that can hold a version of a
        refreshed row are read: a row is never ingested before its event day,
        so ingest_date >= as_of - (days + 1) loses nothing. Conversion feeds
        have a window of their own."""
        df = self.raw[name]
        days = self.p.evc_refresh_days if name.startswith("evc_") else self.p.refresh_days
        if days is not None and "ingest_date" in df.columns:
            import datetime as dt
            lo = self.p.as_of - dt.timedelta(days=days + 1)
            df = df.where(F.col("ingest_date") >= F.lit(lo))
        return df

    @cached_property
    def stg_platform_sales(self) -> DataFrame:
        return self._staged_sales()

    def _staged_sales(self, fact: bool = False) -> DataFrame:
        since = None
        if self.p.refresh_days is not None:
            import datetime as dt
            since = self.p.as_of - dt.timedelta(days=self.p.refresh_days)
        return conform.stg_platform_sales(self.bronze("shopee_orders"), self.bronze("tiktok_shop_orders"),
                                          self.dim_market, self.traffic_map, since=since, fact=fact)

    @cached_property
    def stg_onplatform_ads(self) -> DataFrame:
        return conform.stg_onplatform_ads(self.bronze("tiktok_ads_daily"), self.bronze("shopee_ads_daily"),
                                          self.fx, compat=self.p.compat)

    @cached_property
    def stg_offplatform_ads(self) -> DataFrame:
        return conform.stg_offplatform_ads(self.bronze("meta_cpas_daily"), self.bronze("google_ads_shopee_daily"),
                                           self.fx, compat=self.p.compat)

    @cached_property
    def stg_evc(self) -> DataFrame:
        return conform.stg_evc(self.bronze("evc_google"), self.bronze("evc_meta"), self.bronze("evc_tiktok"),
                               compat=self.p.compat)

    # -- facts ---------------------------------------------------------------
    @cached_property
    def fact_platform_sales(self) -> DataFrame:
        return self._sales_fact()

    def _sales_fact(self, day_ranges: bool = False) -> DataFrame:
        return facts.fact_platform_sales(self._staged_sales(fact=True), self.fx, self.p.as_of, self.p.refresh_days,
                                         day_ranges)

    @cached_property
    def fact_onplatform_ads(self) -> DataFrame:
        return facts.fact_onplatform_ads(self.stg_onplatform_ads, self.p.as_of, self.p.refresh_days)

    @cached_property
    def fact_offplatform_ads(self) -> DataFrame:
        return facts.fact_offplatform_ads(self.stg_offplatform_ads, self.p.as_of, self.p.refresh_days)

    @cached_property
    def fact_evc(self) -> DataFrame:
        return facts.fact_evc(self.stg_evc, self.dim_market, self.fx, self.p.as_of, self.p.evc_refresh_days)

    def in_day_ranges(self, name: str) -> DataFrame | None:
        """A fact whose tasks have ranges of days, for its writer; None for
        tables that have no such form."""
        if name == "fact_platform_sales":
            return self._sales_fact(day_ranges=True)
        if name == "fact_onplatform_ads":
            return facts.fact_onplatform_ads(self.stg_onplatform_ads, self.p.as_of, self.p.refresh_days, day_ranges=True)
        if name == "fact_offplatform_ads":
            return facts.fact_offplatform_ads(self.stg_offplatform_ads, self.p.as_of, self.p.refresh_days, day_ranges=True)
        return None

    # -- marts ---------------------------------------------------------------
    # The panel is bounded by days x markets x channels whatever the order
    # volume behind it, so every analytics reader shares one persisted copy
    # (memory and disk; blocks lost with an executor are recomputed from
    # lineage).
    @cached_property
    def panel(self) -> DataFrame:
        df = panel.daily_channel_panel(self.fact_platform_sales, self.fact_onplatform_ads,
                                       self.fact_offplatform_ads, self.calendar, compat=self.p.compat)
        return self._small(df)

    @cached_property
    def panel_evc(self) -> DataFrame:
        return self._small(panel.daily_channel_panel_evc(self.panel, self.fact_evc))

    # -- analytics -----------------------------------------------------------
    @cached_property
    def scan(self) -> DataFrame:
        from ..operators import metrics
        src = self.panel_evc if self.p.evc else self.panel
        return self._small(metrics.scan_panel(src, self.taxonomy, self.p))

    @cached_property
    def filtered(self) -> DataFrame:
        from ..operators import metrics
        return metrics.filter_range(self.scan, self.p)

    @cached_property
    def deltas(self) -> DataFrame:
        from ..operators import metrics
        return self._small(metrics.channel_deltas(self.scan, self.taxonomy, self.p))

    @cached_property
    def levels(self) -> DataFrame:
        from ..operators import metrics
        return metrics.anomaly_level(self.deltas, self.p)

    @cached_property
    def mkt_deltas(self) -> DataFrame:
        from ..operators import metrics
        return self._small(metrics.market_deltas(self.scan, self.dim_market, self.p))

    @cached_property
    def blended(self) -> DataFrame:
        from ..operators import metrics
        return self._small(metrics.weekly_blended(self.scan, self.p))

    @cached_property
    def event_uplifts(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(*e, None) for e in bind.TEST_EVENTS] + bind.TEST_CHANNEL_EVENTS,
            "event_name string, event_kind string, start date, end date, markets array<string>, "
            "uplift_mult double, channels array<string>")

    @cached_property
    def seasonality(self) -> DataFrame:
        from ..operators import response
        return response.seasonality_multiplier(self.panel.drop("channel"), self.event_uplifts)

    @cached_property
    def channel_seasonality(self) -> DataFrame:
        from ..operators import response
        return response.seasonality_multiplier(self.panel, self.event_uplifts)

    def _small(self, df: DataFrame) -> DataFrame:
        """Persist a frame bounded by the calendar x markets x channels (scan,
        deltas): readers with several branches then share one computation."""
        if not self.cache_marts:
            return df
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(df)
        return df

    def release(self) -> None:
        """Unpersist what this chain holds and forget every derived frame."""
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
        for k in [k for k in self.__dict__ if k in self.DERIVED or k.startswith("stg_")]:
            self.__dict__.pop(k)

    def _folder(self) -> str:
        """A new folder of the shared checkpoint location."""
        import uuid
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/mediapanel-{uuid.uuid4().hex[:12]}"

    @cached_property
    def landed(self) -> "Chain":
        """This chain over feeds landed once."""
        out = Chain(self.spark, self.sf_dir, self.p, self.cache_marts)
        out.land_bronze(self._folder())
        return out

    @cached_property
    def stored(self) -> "Chain":
        """This chain over written tables: feeds landed and facts and marts
        materialised once."""
        out = Chain(self.spark, self.sf_dir, self.p, self.cache_marts)
        out.raw = self.landed.raw
        out.paths = out.materialize(self._folder())
        return out

    # -- persistence ---------------------------------------------------------
    MATERIALIZED = ("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads", "fact_evc",
                    "panel", "panel_evc")
    DERIVED = MATERIALIZED + ("scan", "filtered", "deltas", "levels", "mkt_deltas", "blended", "seasonality",
                              "channel_seasonality", "landed", "stored", "published")

    def land_bronze(self, base_path: str, parallelism: int = 4) -> dict[str, str]:
        """IO2: write the nine raw feeds as append-only bronze tables
        partitioned by ingest day and read them back, as the daily load does;
        the transform chain then starts from tables. Each feed is derived on
        its own: the order feeds join disjoint halves of the order lines, and
        nothing as large as a feed is kept in memory."""
        paths = {}

        def land(name):
            path = f"{base_path.rstrip('/')}/bronze/{name}"
            (bind.landing_feed(self.spark, self.sf_dir, name).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").option("compression", "zstd")
             .partitionBy(bind.INGEST_DAY).parquet(path))
            paths[name] = path

        with shuffles_dropped(self.spark):
            _run_parallel(land, list(bind.RAW_BUILDERS), parallelism)
        self.release()
        for name, path in paths.items():
            self.raw[name] = self.spark.read.parquet(path)
        return paths

    def _write(self, name: str, df: DataFrame, path: str, clustered: bool = False) -> None:
        from ..operators.upsert import write_partitions
        write_partitions(df, path, "date_local", self._sort(df), clustered)

    def _read(self, name: str, path: str, columns: list[str]) -> None:
        df = self.spark.read.parquet(path).select(*columns)
        self.__dict__[name] = self._small(df) if name.startswith("panel") else df

    def materialize(self, base_path: str, names=MATERIALIZED, parallelism: int = 4) -> dict[str, str]:
        """Write facts and marts as parquet partitioned by ``date_local`` under
        ``base_path`` (a folder in the shared checkpoint location on a
        cluster) and read them back, so downstream stages start from the
        written tables instead of re-deriving them: this cuts the lineage,
        and a lost executor only recomputes from the last written table."""
        paths = {}
        kept = {n: self.__dict__[n] for n in self.MATERIALIZED if n in self.__dict__ and n not in names}
        self.release()
        self.__dict__.update(kept)

        def write(n):
            paths[n] = f"{base_path.rstrip('/')}/{n}"
            dealt = self.in_day_ranges(n)
            df = getattr(self, n) if dealt is None else dealt
            self._write(n, df, paths[n], dealt is not None)
            return n, df.columns

        # Facts are independent of each other; the marts read the written facts.
        for n in ("fx", "calendar", "dim_market", "traffic_map"):
            getattr(self, n)
        waves = [[n for n in names if n.startswith("fact_")], [n for n in names if n == "panel"],
                 [n for n in names if n not in self.MATERIALIZED[:5]]]
        with shuffles_dropped(self.spark):
            for wave in waves:
                for n, columns in _run_parallel(write, wave, parallelism):
                    self.__dict__.pop(n, None)
                    self._read(n, paths[n], columns)
        return paths

    def merged_facts(self, target: dict[str, DataFrame], refresh_days: int, evc_refresh_days: int,
                     replace_from=None, whole: bool = False) -> dict[str, DataFrame]:
        """J11 for every fact: this chain's rows of the trailing window upserted
        into the target's rows of those days (``whole``: of all days, so that
        the target is read once). Keys the target alone has stay (D8), unless
        ``replace_from`` names a day from which they go."""
        from dataclasses import replace

        from ..operators.facts import KEYS
        from ..operators.upsert import upsert
        inc = Chain(self.spark, self.sf_dir, replace(self.p, refresh_days=refresh_days,
                                                     evc_refresh_days=evc_refresh_days), False)
        inc.raw = self.raw
        out = {}
        for n, df in target.items():
            lo = F.date_sub(F.lit(self.p.as_of), evc_refresh_days if n == "fact_evc" else refresh_days)
            old = df if whole else df.where(F.col("date_local") >= lo)
            out[n] = upsert(old, getattr(inc, n).select(*df.columns), KEYS[n], replace_from)
        return out

    def refresh(self, paths: dict[str, str], refresh_days: int = 21, evc_refresh_days: int = 365,
                parallelism: int = 4, replace_from=None) -> "Chain":
        """The daily job after the first load (P6, PF9, J11): facts of the
        trailing window are rebuilt from the ingest partitions that can hold a
        version of those days and upserted into the written facts, one
        window for sales and ads, one for conversions. Only days of the window
        are rewritten, in the facts and in both marts, at their published
        paths. Returns a chain that reads them."""
        facts_ = [n for n in self.MATERIALIZED if n.startswith("fact_")]
        schemas = {n: self.spark.read.parquet(paths[n]).columns for n in self.MATERIALIZED}

        def target(n):
            return self.spark.read.parquet(paths[n]).select(*schemas[n])

        merged = self.merged_facts({n: target(n) for n in facts_}, refresh_days, evc_refresh_days, replace_from)
        for n in ("fx", "calendar", "dim_market", "traffic_map"):
            getattr(self, n)
        _run_parallel(lambda n: self._write(n, merged[n], paths[n]), facts_, parallelism)

        # Marts are functions of their day: only days of the windows are rebuilt.
        lo = F.date_sub(F.lit(self.p.as_of), refresh_days)
        evc_lo = F.date_sub(F.lit(self.p.as_of), max(evc_refresh_days, refresh_days))
        day = F.col("date_local")
        part = panel.daily_channel_panel(*[target(n).where(day >= lo) for n in facts_[:3]], self.calendar,
                                         compat=self.p.compat)
        self._write("panel", part.select(*schemas["panel"]), paths["panel"])
        part = panel.daily_channel_panel_evc(target("panel").where(day >= evc_lo), target("fact_evc").where(day >= evc_lo))
        self._write("panel_evc", part.select(*schemas["panel_evc"]), paths["panel_evc"])
        self.release()
        out = Chain(self.spark, self.sf_dir, self.p, self.cache_marts)
        out.raw = self.raw
        for n in self.MATERIALIZED:
            out._read(n, paths[n], schemas[n])
        return out

    # -- published versions --------------------------------------------------
    def ingested_until(self):
        """Latest ingest time of any feed."""
        latest = [self.raw[n].agg(F.max("ingested_at").alias("at")) for n in bind.RAW_BUILDERS]
        return reduce(DataFrame.unionByName, latest).agg(F.max("at")).first()[0]

    def touched_days(self, since) -> dict[str, list]:
        """Per fact the days that rows ingested after ``since`` belong to:
        bounded by the calendar. Read from the ingest partitions of that time,
        conformed but not de-duplicated."""
        new = Chain(self.spark, self.sf_dir, self.p, False)

        def recent(df):
            df = df.where(F.col("ingested_at") > F.lit(since))
            if "ingest_date" in df.columns:
                df = df.where(F.col("ingest_date") >= F.lit(since.date()))
            return df
        r = {n: recent(self.raw[n]) for n in bind.RAW_BUILDERS}
        every = lambda df, keys, order: df
        rows = {
            "fact_platform_sales": conform.stg_platform_sales(r["shopee_orders"], r["tiktok_shop_orders"], new.dim_market,
                                                              new.traffic_map, dedup=every),
            "fact_onplatform_ads": conform.stg_onplatform_ads(r["tiktok_ads_daily"], r["shopee_ads_daily"], new.fx,
                                                              compat=self.p.compat, dedup=every),
            "fact_offplatform_ads": conform.stg_offplatform_ads(r["meta_cpas_daily"], r["google_ads_shopee_daily"], new.fx,
                                                                compat=self.p.compat, dedup=every),
            "fact_evc": conform.evc_rows(r["evc_google"], r["evc_meta"], r["evc_tiktok"], self.p.compat)}
        days = reduce(DataFrame.unionByName, [df.where(F.col("date_local").isNotNull()).select(
            F.lit(n).alias("fact"), "date_local").distinct() for n, df in rows.items()]).collect()
        return {n: sorted(d["date_local"] for d in days if d["fact"] == n) for n in rows}

    def publish(self, base_path: str):
        """The first load as published snapshots: facts and marts in one version."""
        from ..operators.publish import Snapshots
        store = Snapshots(self.spark, base_path)
        draft = store.draft()
        with shuffles_dropped(self.spark):
            for n in self.MATERIALIZED:
                if n.startswith("fact_"):
                    dealt = self.in_day_ranges(n)
                    df = getattr(self, n) if dealt is None else dealt
                    draft.write(n, df, sort_by=self._sort(df), clustered=dealt is not None)
            self._publish_marts(draft, None, None)
        draft.publish(self.ingested_until())
        return store

    def refresh_published(self, store, replace_days: bool = False) -> int | None:
        """The daily job on published snapshots (P6, PF9, J11): only days that
        rows ingested since the last version belong to are rebuilt, from the
        ingest partitions that can hold their versions, and upserted; then the
        marts of those days; then all of it is published at once. Keys of those
        days that the target alone has stay (D8), unless ``replace_days``.
        Returns the new version, or None if nothing has come."""
        import datetime as dt
        from dataclasses import replace

        from ..operators.facts import KEYS
        from ..operators.upsert import upsert
        draft = store.draft()
        mark = self.ingested_until()
        touched = self.touched_days(dt.datetime.fromisoformat(draft.manifest["mark"]))
        if not any(touched.values()):
            return None
        age = lambda days: (self.p.as_of - days[0]).days if days else 0
        inc = Chain(self.spark, self.sf_dir, replace(
            self.p, refresh_days=max(age(d) for n, d in touched.items() if n != "fact_evc"),
            evc_refresh_days=age(touched["fact_evc"])), False)
        inc.raw = self.raw
        with shuffles_dropped(self.spark):
            for n, days in touched.items():
                if days:
                    old = draft.read(n, days)
                    dealt = inc.in_day_ranges(n) if replace_days else None
                    new = getattr(inc, n) if dealt is None else dealt
                    new = new.where(F.col("date_local").isin(days)).select(*old.columns)
                    draft.write(n, new if replace_days else upsert(old, new, KEYS[n]), days, self._sort(old), dealt is not None)
            facts_ = sorted({d for n, days in touched.items() if n != "fact_evc" for d in days})
            self._publish_marts(draft, facts_, sorted({*facts_, *touched["fact_evc"]}))
        return draft.publish(mark)

    @staticmethod
    def _sort(df: DataFrame) -> list[str]:
        return [c for c in ("market", "platform", "channel") if c in df.columns]

    def _publish_marts(self, draft, days, evc_days) -> None:
        """Both marts are functions of their day: days of the draft's facts."""
        if days is None or days:
            part = panel.daily_channel_panel(*[draft.read(n, days) for n in self.MATERIALIZED[:3]], self.calendar,
                                             compat=self.p.compat)
            draft.write("panel", part, days, self._sort(part))
        if evc_days is None or evc_days:
            part = panel.daily_channel_panel_evc(draft.read("panel", evc_days), draft.read("fact_evc", evc_days))
            draft.write("panel_evc", part, evc_days, self._sort(part))

    @cached_property
    def published(self):
        """This chain's facts and marts as published snapshots, once. Every fact
        is written once, into its snapshot; the marts start from there."""
        return self.publish(self._folder())

    def register_views(self, names=("stg_platform_sales", "stg_onplatform_ads", "stg_offplatform_ads", "stg_evc",
                                    "fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads",
                                    "fact_evc", "panel", "panel_evc")) -> list[str]:
        """IO12 views: expose each stage as a temp view for SQL users
        (create-or-replace; views stay lazy)."""
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
        return list(names)
