"""Incremental maintenance of facts: null-safe upsert (J11), insert-if-missing
(J12) and the late-data policy (P6).

Parquet tables have no MERGE, so an upsert is expressed as
``source UNION (target ANTI JOIN source ON null-safe keys)``. Spark plans
the null-safe equality as a hash / sort-merge join key (coalesce + isnull
rewrite), so this is one shuffle of each side on the key, never a nested loop.
Rewrites are scoped to the touched ``date_local`` partitions (dynamic
partition overwrite), see ``write_partitions``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a null-safe key match in ``right``. Both sides
    are aliased: they often share lineage (same bronze tables)."""
    l, r = left.alias("_l"), right.select(*keys).alias("_r")
    cond = reduce(lambda a, b: a & b, [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys])
    return l.join(r, cond, "left_anti").select(*[F.col(f"_l.{c}").alias(c) for c in left.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], replace_from: dt.date | None = None) -> DataFrame:
    """Rows of ``source`` replace target rows with the same (null-safe)
    key; other target rows are kept (D8: nothing is deleted), unless
    ``replace_from`` is given: then target rows dated on or after it that the
    source no longer has are dropped too (full refresh of the window)."""
    src = source.select(*target.columns)
    tgt = target
    if replace_from is not None:
        tgt = tgt.where(F.col("date_local") < F.lit(replace_from))
    kept = _anti(tgt, src, keys)
    return src.unionByName(kept)


def insert_if_missing(target: DataFrame, source: DataFrame, keys: list[str],
                      flag_col: str | None = None) -> DataFrame:
    """Append source rows whose key is absent from the target; existing
    rows are never updated. ``flag_col`` marks the inserted rows."""
    src = source.select(*target.columns)
    new = _anti(src, target, keys)
    if flag_col:
        return target.withColumn(flag_col, F.lit(False)).unionByName(new.withColumn(flag_col, F.lit(True)))
    return target.unionByName(new)


def final_flag(df: DataFrame, as_of: dt.date, lag_days: int = 14) -> DataFrame:
    """Days older than the re-read window (as_of - (lag - 1)) are final:
    no later load can change them."""
    return df.withColumn("is_final", F.col("date_local") < F.date_sub(F.lit(as_of), lag_days - 1))


def write_partitions(df: DataFrame, path: str, partition_by: str = "date_local",
                     sort_by: list[str] | None = None, clustered: bool = False) -> None:
    """IO12 sink for facts and marts: rewrite only the partitions present in
    ``df`` (dynamic partition overwrite).

    Rows are clustered with AQE's ``rebalance`` on the partition column: small
    inputs are coalesced into few files per day, and a hot day (a mega-sale day
    may hold a large share of all rows) is split across several tasks instead
    of landing in one (``optimizeSkewsInRebalancePartitions``). Files are
    sorted on ``sort_by`` for min/max skipping. ``df`` may read the path it
    rewrites: new files are committed, and the old ones of those partitions
    removed, only after every task has finished. The overwrite mode is an
    option of this write; the session keeps its own. ``clustered`` says that the
    rows of ``df`` come in ranges of the partition column: they are not shuffled."""
    out = (df if clustered else df.hint("rebalance", partition_by)).sortWithinPartitions(partition_by, *(sort_by or []))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(partition_by).parquet(path))
