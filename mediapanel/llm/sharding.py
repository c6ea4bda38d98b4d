"""Sharding by a hierarchical weighted hash tree.

A tree has three levels: regions, racks, shards. A row descends it by its key
alone: at each level every child draws ``ln(u) / weight`` with ``u`` from a
64-bit hash of (key, path of the child), and the largest draw wins, so a child
gets its share of its parent's weight. A draw depends on nothing but key, path
and weight; raising one child's weight moves rows only into that child, and
all movement stays inside the subtrees whose weights change.

``topology(n)`` lays the first ``base`` shards out over regions and racks.
Every later shard opens a region of its own, whose whole weight is that shard,
so going from n to n + 1 shards (n >= base) takes rows only into the new one.

Law of the registered query: ``key``. Null keys count as the text ``null``; a
null text has 0 bytes and the CRC of the empty text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mediapanel.llm.common import text_or_empty

# (shard, bucket) groups are the unit in which slots are numbered; 4,096 per
# shard keep a group at 1/163,840 of the rows of 40 shards.
SLOT_BUCKETS = 4096


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, base: int = 40, regions: int = 2, racks: int = 4) -> list[Leaf]:
    """``base`` shards dealt over regions x racks; one region per later shard."""
    first = min(shards, base)
    leaves = [Leaf(s * regions // first, s * regions * racks // first % racks, s) for s in range(first)]
    return leaves + [Leaf(regions + i, 0, base + i) for i in range(shards - first)]


def _children(leaves: list[Leaf]) -> dict[tuple[int, ...], dict[int, float]]:
    """Weight of every child of the root (), of each region and of each rack."""
    tree: dict[tuple[int, ...], dict[int, float]] = {}
    for x in leaves:
        if x.weight <= 0:
            continue
        for parent, child in (((), x.region), ((x.region,), x.rack), ((x.region, x.rack), x.shard)):
            kids = tree.setdefault(parent, {})
            kids[child] = kids.get(child, 0.0) + x.weight
    return tree


def _draw(key: Column, path: Column, weight: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(path, F.lit("/"), key)), 11).cast("double")
    return F.log((bits + 0.5) / F.lit(float(2 ** 53))) / weight


def _winner(key: Column, prefix: Column, kids: Column) -> Column:
    """Child of ``kids`` (array of (id, weight)) with the largest draw."""
    drawn = F.transform(kids, lambda k: F.struct(
        _draw(key, F.concat(prefix, F.lit("/"), k["id"].cast("string")), k["weight"]).alias("draw"),
        k["id"].alias("id")))
    return F.array_max(drawn)["id"]


def _kids_literal(kids: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(c).cast("int").alias("id"), F.lit(w).cast("double").alias("weight"))
                     for c, w in sorted(kids.items())])


def with_shard(df: DataFrame, key: Column, leaves: list[Leaf], out: str) -> DataFrame:
    """``df`` plus the int column ``out``: the shard that ``key`` descends to."""
    tree = _children(leaves)
    k, reg, rack = F.coalesce(key.cast("string"), F.lit("null")), f"__{out}_region", f"__{out}_rack"
    df = df.withColumn(reg, _winner(k, F.lit("region"), _kids_literal(tree[()])))
    racks = F.create_map(*[x for p, kids in tree.items() if len(p) == 1
                           for x in (F.lit(p[0]), _kids_literal(kids))])
    df = df.withColumn(rack, _winner(k, F.concat(F.lit("rack/"), F.col(reg).cast("string")), racks[F.col(reg)]))
    at = F.concat_ws("/", F.col(reg).cast("string"), F.col(rack).cast("string"))
    shards = F.create_map(*[x for p, kids in tree.items() if len(p) == 2
                            for x in (F.lit(f"{p[0]}/{p[1]}"), _kids_literal(kids))])
    return df.withColumn(out, _winner(k, F.concat(F.lit("shard/"), at), shards[at])).drop(reg, rack)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shard, gapless slot within the shard and the shard after one more is
    added, per row of ``docs`` (doc_id, text).

    Rows of a shard are ordered by (bucket of the key, doc_id, CRC, size), so
    equal rows may swap slots and nothing else can. Counts per (shard, bucket)
    come from the ids alone; one ordered window per such group numbers its
    rows, and no task holds a whole shard.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    now, grown = topology(shards), topology(shards + 1)
    key = F.col("doc_id").cast("string")
    bucket = F.pmod(F.xxhash64(F.concat(F.lit("slot/"), F.coalesce(key, F.lit("null")))), F.lit(SLOT_BUCKETS))

    ids = with_shard(docs.select("doc_id"), key, now, "shard")
    counts = ids.withColumn("bucket", bucket).groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    text = text_or_empty(F.col("text")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = with_shard(with_shard(rows, key, now, "shard"), key, grown, "grown_shard").withColumn("bucket", bucket)
    within = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (rows.join(offsets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.row_number().over(within) - 1).cast("long").alias("slot"),
                    "grown_shard"))
