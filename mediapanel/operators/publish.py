"""IO12 + J11: facts and marts that change together.

Tables are folders of day snapshots, ``data/<table>/date_local=<day>/snap=<id>``,
that are written once and never changed. A manifest names the snapshot of each
day of every table; publishing is one rename of a new manifest, so readers see
all tables of a refresh or none, and a refresh that dies at any point leaves the
published version whole. Only days that a draft wrote change their snapshot.

The manifest also keeps the row count, markets and channels of each day, so
table metadata needs no scan (IO11). Its size is bounded by tables x days, and
readers hand Spark the folders of the days they ask for.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import _fs

DAY = "date_local"
META_COLUMNS = ("market", "channel")
MANIFEST = re.compile(r"(\d{10})\.json")


class Conflict(RuntimeError):
    """Another draft was published first."""


class Snapshots:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, *parts: str) -> str:
        return "/".join((self.base, *parts))

    # -- manifests -----------------------------------------------------------
    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self._path("manifest"))
        if not fs.exists(p):
            return []
        found = [MANIFEST.fullmatch(f.getPath().getName()) for f in fs.listStatus(p)]
        return sorted(int(m.group(1)) for m in found if m)

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        """The published manifest (of ``version``); empty before the first."""
        if version is None:
            known = self.versions()
            if not known:
                return {"version": 0, "tables": {}, "mark": None}
            version = known[-1]
        fs, p = _fs(self.spark, self._path("manifest", f"{version:010d}.json"))
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _switch(self, manifest: dict[str, Any]) -> None:
        """Write a manifest beside the others and rename it to its version; the
        rename fails if that version is there."""
        fs, tmp = _fs(self.spark, self._path("manifest", f"_{uuid.uuid4().hex}.json"))
        _, final = _fs(self.spark, self._path("manifest", f"{manifest['version']:010d}.json"))
        out = fs.create(tmp)
        try:
            out.write(json.dumps(manifest).encode("utf-8"))
        finally:
            out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(tmp, final, options)
        except Exception as e:
            fs.delete(tmp, False)
            if fs.exists(final):
                raise Conflict(f"version {manifest['version']} is published already") from e
            raise

    # -- readers -------------------------------------------------------------
    def read(self, name: str, days: list[dt.date] | None = None, manifest: dict[str, Any] | None = None) -> DataFrame:
        """A published table, or the days of it that are asked for."""
        table = (manifest or self.manifest())["tables"][name]
        schema = T.StructType.fromJson(table["schema"])
        wanted = None if days is None else {d.isoformat() for d in days}
        paths = [self._path("data", name, f"{DAY}={d}", f"snap={e['snap']}") for d, e in table["days"].items()
                 if wanted is None or d in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(T.StructType([*schema.fields, T.StructField("snap", T.StringType())]))
                .option("basePath", self._path("data", name)).parquet(*paths).select(*schema.names))

    def meta(self, name: str) -> DataFrame:
        """IO11 of a published table from the manifest alone."""
        days = self.manifest()["tables"][name]["days"]
        held = lambda c: ",".join(sorted({x for e in days.values() for x in e.get(c, ())}))
        row = (dt.date.fromisoformat(min(days)) if days else None, dt.date.fromisoformat(max(days)) if days else None,
               sum(e["rows"] for e in days.values()), held("market"), held("channel"))
        return self.spark.createDataFrame([row], "min_date date, max_date date, row_count long, markets string, channels string")

    # -- writers -------------------------------------------------------------
    def draft(self) -> "Draft":
        return Draft(self)

    def vacuum(self, keep: int = 2) -> int:
        """Delete snapshots that none of the last ``keep`` versions names, and
        those versions' older manifests; the number of snapshots deleted. Drafts
        in work have a later version than the published one and are left."""
        versions = self.versions()
        held = versions[-keep:]
        named = {(n, d, e["snap"]) for v in held for n, t in self.manifest(v)["tables"].items() for d, e in t["days"].items()}
        fs, top = _fs(self.spark, self._path("data"))
        gone = 0
        for table in fs.listStatus(top) if held and fs.exists(top) else []:
            for day in fs.listStatus(table.getPath()):
                for snap in fs.listStatus(day.getPath()) if day.isDirectory() else []:
                    label = snap.getPath().getName().split("=", 1)[-1]
                    key = (table.getPath().getName(), day.getPath().getName().split("=", 1)[-1], label)
                    if snap.isDirectory() and key not in named and int(label[1:11]) <= held[-1]:
                        fs.delete(snap.getPath(), True)
                        gone += 1
        for v in versions[:-keep]:
            f, p = _fs(self.spark, self._path("manifest", f"{v:010d}.json"))
            f.delete(p, False)
        return gone


class Draft:
    """A next version in work: reads see what it wrote over what is published."""

    def __init__(self, store: Snapshots):
        self.store = store
        self.manifest = json.loads(json.dumps(store.manifest()))
        self.manifest["version"] += 1
        self.snap = f"v{self.manifest['version']:010d}-{uuid.uuid4().hex[:12]}"

    def read(self, name: str, days: list[dt.date] | None = None) -> DataFrame:
        return self.store.read(name, days, self.manifest)

    def write(self, name: str, df: DataFrame, days: list[dt.date] | None = None, sort_by: list[str] | None = None,
              clustered: bool = False) -> None:
        """Replace the days present in ``df``, and those of ``days`` whether or
        not ``df`` has rows for them. Rows without a day are left out.
        ``clustered`` says that the rows come in ranges of days."""
        spark = self.store.spark
        folder = self.store._path("data", name)
        rows = df.where(F.col(DAY).isNotNull()).withColumn("snap", F.lit(self.snap))
        # As in ``write_partitions``: few files a day, a hot day split across tasks.
        ((rows if clustered else rows.hint("rebalance", DAY)).sortWithinPartitions(DAY, "snap", *(sort_by or []))
         .write.mode("append").option("compression", "zstd").partitionBy(DAY, "snap").parquet(folder))
        table = self.manifest["tables"].setdefault(name, {"days": {}})
        table["schema"] = json.loads(df.schema.json())
        for d in days or ():
            table["days"].pop(d.isoformat(), None)
        fs, top = _fs(spark, folder)
        written = [s.getPath().getParent().getName().split("=", 1)[1]
                   for s in fs.globStatus(_fs(spark, f"{folder}/{DAY}=*/snap={self.snap}")[1])]
        if not written:
            return
        table["days"].update({d: {"snap": self.snap} for d in written})
        # Counts of the new days only: footers, and the two columns a mart has.
        held = [c for c in META_COLUMNS if c in df.columns]
        stats = self.read(name, [dt.date.fromisoformat(d) for d in written]).groupBy(DAY).agg(
            F.count(F.lit(1)).alias("rows"), *[F.sort_array(F.collect_set(c)).alias(c) for c in held])
        for r in stats.collect():
            table["days"][r[DAY].isoformat()] |= {"rows": r["rows"], **{c: r[c] for c in held}}
        table["days"] = dict(sorted(table["days"].items()))

    def publish(self, mark: dt.datetime | None = None) -> int:
        """Switch readers to this draft; ``mark`` says up to when rows were
        ingested into it."""
        if mark is not None:
            self.manifest["mark"] = mark.isoformat()
        self.store._switch(self.manifest)
        return self.manifest["version"]
