"""Sources and sinks of the bronze layer (IO2-IO9, IO12).

Landing data is newline-delimited JSON read with the declared schemas (no
inference; unknown fields dropped); API envelopes are flattened with JSON
functions; sinks write partitioned parquet, NDJSON or CSV.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LINEAGE

LINEAGE_COLS = [n for n, _ in LINEAGE]


def load_ndjson(spark: SparkSession, path: str, schema: T.StructType, ingested_at: dt.datetime) -> DataFrame:
    """IO2: read NDJSON with the table schema; fields not in the schema are
    ignored; a missing ``ingested_at`` takes the load time; blank lines are
    skipped by the reader; a line that does not parse fails the load."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.withColumn("ingested_at", F.coalesce(F.col("ingested_at"), F.lit(ingested_at).cast("timestamp")))


def load_ndjson_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                             ingested_at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """IO2 with a quarantine: the rows that parse, and the lines that do not
    (column ``line``), neither of them lost."""
    corrupt = "_corrupt_record"
    df = (spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).json(path))
    good = df.where(F.col(corrupt).isNull()).drop(corrupt).withColumn(
        "ingested_at", F.coalesce(F.col("ingested_at"), F.lit(ingested_at).cast("timestamp")))
    # The reader refuses to look at the corrupt column alone: the lines are
    # asked for together with the data columns.
    line = F.when(F.size(F.array(*[F.col(f.name).isNull() for f in schema.fields])) > 0, F.col(corrupt))
    return good, df.select(line.alias("line")).where(F.col("line").isNotNull())


def append_bronze(df: DataFrame, path: str) -> int:
    """IO2 sink: append to the bronze table partitioned by ingest day; the
    number of rows, observed while they are written. Empty input adds none."""
    seen = Observation()
    out = df.withColumn("ingest_date", F.to_date("ingested_at")).observe(seen, F.count(F.lit(1)).alias("n"))
    out.write.mode("append").partitionBy("ingest_date").parquet(path)
    return seen.get["n"]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


UNKNOWN = "unknown"


def replay_landing(spark: SparkSession, root: str, source: str, schema: T.StructType) -> DataFrame | None:
    """IO3: replay ``<root>/<source>/<market>/<day>.ndjson``; a row without a
    market takes it from the path; a missing source folder yields None."""
    base = f"{root.rstrip('/')}/{source}"
    if not path_exists(spark, base):
        return None
    df = (spark.read.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
          .option("pathGlobFilter", "*.ndjson").json(base))
    mk = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+\.ndjson$", 1)
    return df.withColumn("_market", F.coalesce(F.col("_market"), F.when(~mk.isin("", UNKNOWN), F.url_decode(mk))))


def write_landing(df: DataFrame, root: str, source: str, day_col: str = "Date") -> int:
    """IO4: NDJSON files ``<root>/<source>/<market>/<day>.ndjson`` (missing
    values: ``unknown``) and the number of rows. A day that several tasks
    wrote has files ``<day>.1.ndjson`` and so on beside the first. A day written
    again replaces all of its files.

    Spark writes partition folders beside the target; their files are then
    renamed, one rename per file of (market, day)."""
    from urllib.parse import unquote
    spark = df.sparkSession
    seen = Observation()
    out = (df.withColumn("_part_market", F.coalesce(F.col("_market"), F.lit(UNKNOWN)))
           .withColumn("_part_day", F.coalesce(F.col(day_col).cast("string"), F.lit(UNKNOWN)))
           .observe(seen, F.count(F.lit(1)).alias("n")))
    base = f"{root.rstrip('/')}/{source}"
    staged = f"{base}/_staged-{uuid.uuid4().hex}"
    out.hint("rebalance", "_part_market", "_part_day").write.partitionBy("_part_market", "_part_day").json(staged)
    fs, top = _fs(spark, staged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for market in fs.listStatus(top):
        if not market.isDirectory():
            continue
        name = unquote(market.getPath().getName().split("=", 1)[1])
        fs.mkdirs(path(f"{base}/{name}"))
        before: dict[str, list] = {}
        for f in fs.listStatus(path(f"{base}/{name}")):
            if m := re.fullmatch(r"(.+?)(\.\d+)?\.ndjson", f.getPath().getName()):
                before.setdefault(m.group(1), []).append(f.getPath())
        for day in fs.listStatus(market.getPath()):
            label = unquote(day.getPath().getName().split("=", 1)[1])
            parts = [f for f in fs.listStatus(day.getPath()) if f.getPath().getName().startswith("part-")]
            for old in before.get(label, ()):
                fs.delete(old, False)
            for i, f in enumerate(parts):
                fs.rename(f.getPath(), path(f"{base}/{name}/{label}{f'.{i}' if i else ''}.ndjson"))
    fs.delete(top, True)
    return seen.get["n"]


def csv_columns(df: DataFrame, declared: list[str]) -> list[str]:
    """IO5 column order: declared fields, then the lineage block, then extras."""
    decl = [c for c in declared if c in df.columns and c not in LINEAGE_COLS]
    lin = [c for c in LINEAGE_COLS if c in df.columns]
    extra = [c for c in df.columns if c not in decl and c not in lin]
    return decl + lin + extra


def write_csv(df: DataFrame, path: str, declared: list[str]) -> None:
    """IO5: CSV sink; NULL -> empty, booleans lower-case, ISO dates."""
    cols = csv_columns(df, declared)
    out = df.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if isinstance(df.schema[c].dataType, T.TimestampType)
                      else F.col(c) for c in cols]).toDF(*cols)
    (out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def flatten_envelope(landing: DataFrame, col: str = "body") -> DataFrame:
    """IO6: flatten API envelopes ``{"data": [[header...], [row...], ...]}``
    (2-D) or ``{"data": [{...}, ...]}`` (list of objects) into one
    ``map<string,string>`` per row; anything else yields no rows.

    Elements of ``data`` are read as JSON text, then parsed as an array
    (2-D form: the first element is the header) or as an object.
    """
    data = F.from_json(F.col(col), "struct<data: array<string>>").getField("data")
    env = landing.select("*", data.alias("_data")).where(F.size("_data") > 0)
    first = F.element_at("_data", 1)
    is_2d = F.ltrim(first).startswith("[")
    two_d = env.where(is_2d).select(
        "*", F.from_json(first, "array<string>").alias("_hdr"),
        F.explode(F.slice("_data", 2, F.greatest(F.size("_data") - 1, F.lit(1)))).alias("_row")
    ).where(F.size("_data") > 1).select(
        *[c for c in landing.columns],
        F.map_from_arrays("_hdr", F.from_json("_row", "array<string>")).alias("record"))
    objs = env.where(F.ltrim(first).startswith("{")).select(
        "*", F.explode("_data").alias("_row")).select(
        *[c for c in landing.columns], F.from_json("_row", "map<string,string>").alias("record"))
    return two_d.unionByName(objs)


def typed_records(records: DataFrame, schema: T.StructType, col: str = "record") -> DataFrame:
    """IO6 typing: map fields to the declared schema with ``try_cast``; a
    value that does not parse becomes NULL instead of failing the load."""
    return records.select(*[F.element_at(F.col(col), f.name).try_cast(f.dataType).alias(f.name)
                            for f in schema.fields])


def envelope_pages(raw: DataFrame, fields: list[str], page_key: list[Column]) -> DataFrame:
    """Inverse of IO6 for landing files: group rows into 2-D envelopes, one
    per page key. Callers choose a page key whose groups are bounded (an API
    page holds a fixed number of rows)."""
    row = F.array(*[F.col(f).cast("string") for f in fields])
    g = raw.groupBy(*page_key).agg(F.collect_list(row).alias("_rows"))
    header = F.array(*[F.lit(f) for f in fields])
    body = F.to_json(F.struct(F.concat(F.array(header), F.col("_rows")).alias("data")))
    return g.select(body.alias("body"))


def extract_window(df: DataFrame, date_col: str, as_of: dt.date, days: int = 14) -> DataFrame:
    """IO7: the rolling extract window [as_of - (days - 1), as_of]."""
    lo = as_of - dt.timedelta(days=days - 1)
    return df.where(F.col(date_col).between(F.lit(lo), F.lit(as_of)))


def tag_lineage(df: DataFrame, source_system: str, accounts: DataFrame, as_of: dt.date, days: int = 14,
                account_col: str = "account_id") -> DataFrame:
    """IO7: lineage block per row; the market comes from an account map
    (account_id, market)."""
    lo = as_of - dt.timedelta(days=days - 1)
    a = accounts.select(F.col("account_id").alias("_acct"), F.col("market").alias("_acct_market"))
    j = df.join(a, F.col(account_col) == F.col("_acct"), "left")
    return j.select(*df.columns, F.lit(source_system).alias("_source_system"),
                    F.col("_acct_market").alias("_market"), F.col(account_col).alias("_accounts"),
                    F.lit(lo).alias("_window_start"), F.lit(as_of).alias("_window_end"))


def compile_filters(filters: list[dict]) -> Column:
    """IO8: declarative filters {field, op: CONTAINS | STARTS_WITH | IN_LIST,
    value} compiled to one AND-ed predicate (pushed down where possible)."""
    preds = []
    for f in filters:
        c, op, v = F.col(f["field"]), f["op"].upper(), f["value"]
        if op == "CONTAINS":
            preds.append(c.contains(v))
        elif op == "STARTS_WITH":
            preds.append(c.startswith(v))
        elif op == "IN_LIST":
            preds.append(c.isin(*(v if isinstance(v, (list, tuple)) else str(v).split(","))))
        else:
            raise ValueError(f"unknown filter op: {op}")
    return reduce(lambda a, b: a & b, preds, F.lit(True))


# Source name -> the account-config field that holds its accounts.
SOURCE_ACCOUNT_FIELD = {"google_ads_shopee": "google_ads"}


def accounts_for(accounts: DataFrame, source: str, market: str | None = None) -> DataFrame:
    """IO9: accounts configured for (source, market), or for all markets.
    ``accounts`` = (source, market, account_ids array); a source whose
    accounts live under another config name is mapped explicitly (D19)."""
    field = SOURCE_ACCOUNT_FIELD.get(source, source)
    a = accounts.where(F.col("source").isin(source, field))
    if market is not None:
        a = a.where(F.col("market") == market)
    return a.select("source", "market", F.explode("account_ids").alias("account_id"))


def restrict_to_accounts(df: DataFrame, accounts: DataFrame, account_col: str) -> DataFrame:
    """IO9: keep rows of configured accounts (left-semi join)."""
    return df.join(accounts.select(F.col("account_id").alias(account_col)), account_col, "left_semi")
