"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set are the hashes of its distinct word shingles; the ``INDEX_K``
smallest are its sketch. Documents with equal sets form a class at once, and
only one document of a class goes on.

1. Inverted lists. For two sets of Jaccard similarity 0.8 or more, at least
   ``NEED`` of their sketch values are shared (the chance of fewer is below
   1e-8; sets of up to 25 shingles are held whole, so there it is certain).
   With sketch values ordered from rare to common, two such sketches share a
   value among their first ``size - NEED + 1``; only those enter the lists, so
   a passage that a third of all documents hold makes no list of its own
   unless it fills most of the sketch.
2. Every list has a pivot, its member whose values are the most common.
   Members are verified against the pivots of their lists: a few pairs per
   document. Full sets are read again for classes with a list only, found
   through a bitmap of fixed size.
3. Members of one pivot that are both linked to it need no link of their own.
   The others meet all members of the pivot in blocks of bounded size; sizes,
   what is known about the overlap with the pivot, and the estimate from the
   bottom-k of the union (``UNION_K`` values) rule pairs out. Only the estimate,
   which is for two sets of more than ``UNION_K`` shingles, can rule out a link;
   the chance is below 1e-8 per pair.
4. Pairs left are verified on full sets; links are contracted to components.

Null or empty texts have no shingles and no links. Sets are told apart by 64
bits of hash. A component is named by its smallest doc_id; a null doc_id is
only the name of a component without any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mediapanel.llm.common import text_or_empty, written
from mediapanel.llm.components import connected_components

INDEX_K = 32
NEED = 11
WHOLE = 25          # sets up to this size share ceil(0.8 * size) sketch values at least
UNION_K = 256
UNION_NEED = 165    # of UNION_K: 256 draws at 0.8 come to fewer with a chance below 1e-8
UNION_LEAST = UNION_NEED / UNION_K
BLOCK = 512
BITMAP_BITS = 26
HASH_TABLE = 150_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
               0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB)


class ShingleHasher:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""

    def __init__(self, words: int):
        if not 1 <= words <= len(MULTIPLIERS):
            raise ValueError(f"shingles of 1 to {len(MULTIPLIERS)} words")
        self.words = words
        self.hashes: dict[bytes, int] = {}

    def _word_hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash
        table = self.hashes
        if len(table) > HASH_TABLE:
            table.clear()
        out = []
        for w in words:
            h = table.get(w)
            if h is None:
                h = table[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(LOWER).split()  # bytes: splits at \x20 and \x09-\x0D
        if not words:
            return np.zeros(0, np.uint64)
        a = self._word_hashes(words)
        k = min(self.words, len(a))
        n = len(a) - k + 1
        v = np.full(n, k, np.uint64)
        for i in range(k):
            v += a[i:i + n] * np.uint64(MULTIPLIERS[i])
        v ^= v >> np.uint64(31)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(29)
        return np.unique(v)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, row_key, n, cid, sketch) of ``rows`` (doc_id, row_key, text);
    cid, the hash of the set, is null for an empty set. Sketch values are in
    the order of unsigned hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        shingles = ShingleHasher(words)
        for batch in batches:
            n, cid, parts = [], [], []
            for t in batch.column("text").cast(pa.binary()):
                s = shingles(t.as_py())
                n.append(len(s))
                cid.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2 ** 63 if len(s) else None)
                parts.append(s[:INDEX_K])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()),
                 pa.array(cid, pa.int64()), _lists(parts)], names=["doc_id", "row_key", "n", "cid", "sketch"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row_key long, n long, cid long, sketch array<long>")


def index_rows(classes: DataFrame) -> DataFrame:
    """(value, cid, weight): the list entries of each class; weight is higher
    the more common the values of its sketch are."""
    values = classes.select("cid", "n", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    size = F.least(F.col("n"), F.lit(INDEX_K))
    need = F.when(F.col("n") <= WHOLE, F.ceil(F.lit(0.8) * F.col("n") - 1e-9)).otherwise(F.lit(NEED))
    own = W.partitionBy("cid")
    # Values that no other class holds are the rarest and take the first places.
    return (values.join(common, "value")
            .withColumn("alone", size - F.count(F.lit(1)).over(own))
            .withColumn("place", F.row_number().over(own.orderBy("df", "value")))
            .withColumn("weight", F.sum(F.log("df")).over(own))
            .where(F.col("place") + F.col("alone") <= size - need + 1)
            .select("value", "cid", "weight"))


def pivot_pairs(index: DataFrame) -> DataFrame:
    """Distinct (cid, pivot) over all lists."""
    pivots = (index.groupBy("value").agg(F.max(F.struct("weight", "cid")).alias("top"), F.count(F.lit(1)).alias("m"))
              .where(F.col("m") > 1).select("value", F.col("top.cid").alias("pivot")))
    return index.join(pivots, "value").where(F.col("cid") != F.col("pivot")).select("cid", "pivot").distinct()


def bitmap_of(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap of 2 ** bits cells with the hash cells of the long column
    ``row_key`` set, whatever the number of rows."""
    low = 16
    cell = F.shiftrightunsigned(F.col("row_key"), 64 - bits)
    found = (keys.select(F.shiftright(cell, low).alias("segment"), cell.bitwiseAND((1 << low) - 1).cast("int").alias("c"))
             .distinct().groupBy("segment").agg(F.collect_list("c").alias("cells")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for cells in batch.column("cells"):
                on = np.zeros(1 << low, bool)
                on[np.asarray(cells.as_py(), np.int64)] = True
                blobs.append(np.packbits(on, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("segment"), pa.array(blobs, pa.binary())],
                                             names=["segment", "bits"])

    out = np.zeros((1 << (bits - low), 1 << (low - 3)), np.uint8)
    rows = found.mapInArrow(run, "segment long, bits binary").toArrow()
    for segment, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
        out[segment] = np.frombuffer(blob.as_py(), np.uint8)
    return out.reshape(-1)


def full_sets(rows: DataFrame, bitmap: np.ndarray, words: int) -> DataFrame:
    """(cid, items) of the rows whose key is set in ``bitmap`` (and of a few more)."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    bits = int(len(bitmap) * 8).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        bitmap = shared.value
        shingles = ShingleHasher(words)
        for batch in batches:
            cell = (batch.column("row_key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            on = np.flatnonzero((bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
            for part in (on[i:i + 512] for i in range(0, len(on), 512)):
                sets = [s for s in (shingles(t.as_py()) for t in batch.column("text").cast(pa.binary()).take(pa.array(part)))
                        if len(s)]
                cid = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2 ** 63 for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), _lists(sets)], names=["cid", "items"])

    return rows.select("row_key", "text").mapInArrow(run, "cid long, items array<long>")


def overlaps(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` plus sizes ``na``, ``nb`` and ``both`` of the sets of columns a and b."""
    left = sets.select(F.col("cid").alias(a), F.col("items").alias("__a"))
    right = sets.select(F.col("cid").alias(b), F.col("items").alias("__b"))
    both = F.size(F.array_intersect("__a", "__b"))
    return (pairs.join(left, a).join(right, b)
            .select(*pairs.columns, F.size("__a").alias("na"), F.size("__b").alias("nb"), both.alias("both")))


def is_link(both, na, nb):
    return 100 * both >= 80 * (na + nb - both)


def union_estimate(a: np.ndarray, b: np.ndarray, k: int = UNION_K) -> float:
    """Share of the k smallest values of the union that both sketches hold."""
    union = np.union1d(a, b)[:k]
    return float(np.isin(union, np.intersect1d(a, b, True)).sum()) / max(1, len(union))


def _forest(i: np.ndarray, j: np.ndarray, cid: np.ndarray, linked: np.ndarray, sure: np.ndarray) -> list[int]:
    """Indices of the pairs to keep: all that are not sure, and of the sure
    links those that join what the ones before them had not joined."""
    parent: dict[int, int] = {c: -1 if on else c for c, on in zip(cid.tolist(), linked.tolist())}
    parent[-1] = -1  # stands for the pivot

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for k, (a, b, known) in enumerate(zip(cid[i].tolist(), cid[j].tolist(), sure.tolist())):
        if known:
            a, b = root(a), root(b)
            if a == b:
                continue
            parent[max(a, b)] = min(a, b)
        keep.append(k)
    return keep


def block_pairs(side: np.ndarray, cid: np.ndarray, n: np.ndarray, shared: np.ndarray, linked: np.ndarray,
                sketch: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of side 0, row of side 1) that may be similar enough. Side 0
    are members not linked to the pivot, side 1 all members; ``shared`` is the
    overlap with the pivot. Pairs found from both ends count once. Sets that
    the sketch holds whole are compared exactly, and of their links a spanning
    forest is enough."""
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(x) or not len(y):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values, code = np.unique(np.concatenate(sketch), return_inverse=True)
    counts = np.bincount(code)
    dense = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[code]
    owner = np.repeat(np.arange(len(sketch)), [len(s) for s in sketch])
    overlap = np.zeros((len(x), len(y)), np.float32)
    row_x, row_y = np.full(len(side), -1), np.full(len(side), -1)
    row_x[x], row_y[y] = np.arange(len(x)), np.arange(len(y))
    for lo in range(0, int(dense.max()) + 1, 4096):
        part = (dense >= lo) & (dense < lo + 4096)
        mx, my = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
        in_x, in_y = part & (row_x[owner] >= 0), part & (row_y[owner] >= 0)
        mx[row_x[owner[in_x]], dense[in_x] - lo] = 1
        my[row_y[owner[in_y]], dense[in_y] - lo] = 1
        overlap += mx @ my.T
    nx, ny = n[x][:, None], n[y][None, :]
    least = 0.8 / 1.8 * (nx + ny) - 1e-6  # what a link's overlap comes to
    large, small = np.maximum(nx, ny), np.minimum(nx, ny)
    asked = np.where(small <= UNION_K, least - np.maximum(large - UNION_K, 0), UNION_NEED)
    sx, sy = shared[x][:, None], shared[y][None, :]
    most = np.minimum(sx, sy) + np.minimum(nx - sx, ny - sy)  # inside the pivot, and outside it
    ok = (overlap >= asked) & (most >= least) & (small >= 0.8 * large - 1e-6) & (cid[x][:, None] != cid[y][None, :])
    both_open = np.isin(cid[y], cid[x])[None, :]
    ok &= ~both_open | (cid[x][:, None] < cid[y][None, :])
    i, j = np.nonzero(ok)
    sure = large[i, j] <= UNION_K
    est = np.array([known or union_estimate(sketch[x[p]], sketch[y[q]]) >= UNION_LEAST
                    for p, q, known in zip(i, j, sure)], bool)
    i, j, sure = i[est], j[est], sure[est]
    keep = _forest(x[i], y[j], cid, linked, sure)
    return x[i[keep]], y[j[keep]]


def open_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) among the members of one pivot, given
    ``members`` (pivot, cid, n, shared, linked). Groups are dealt into blocks;
    a task sees two of them."""
    sizes = (members.groupBy("pivot").agg(F.count(F.lit(1)).alias("m"), F.sum((~F.col("linked")).cast("long")).alias("open"))
             .where((F.col("m") > 1) & (F.col("open") > 0)))
    k = F.slice("items", 1, UNION_K).alias("sketch")
    rows = members.join(sizes, "pivot").join(sets.select("cid", k), "cid")
    xs, ys = F.ceil(F.col("open") / BLOCK), F.ceil(F.col("m") / BLOCK)
    deal = lambda blocks, salt: F.pmod(F.xxhash64("cid", F.lit(salt)), blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    left = (rows.where(~F.col("linked")).withColumn("x", deal(xs, 1)).withColumn("y", every(ys))
            .withColumn("side", F.lit(0)))
    right = rows.withColumn("y", deal(ys, 2)).withColumn("x", every(xs)).withColumn("side", F.lit(1))
    cols = ["pivot", "x", "y", "side", "cid", "n", "shared", "linked", "sketch"]

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        cid = t.column("cid").to_numpy()
        sketch = [np.asarray(s.as_py(), np.int64).view(np.uint64) for s in t.column("sketch")]
        i, j = block_pairs(t.column("side").to_numpy(), cid, t.column("n").to_numpy(), t.column("shared").to_numpy(),
                           t.column("linked").to_numpy(), sketch)
        return pa.table({"a": pa.array(cid[i], pa.int64()), "b": pa.array(cid[j], pa.int64())})

    return (left.select(*cols).unionByName(right.select(*cols)).groupBy("pivot", "x", "y")
            .applyInArrow(run, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _components(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, row_key, n, group, name) per row of ``rows`` (doc_id, row_key,
    text): the component's key and its smallest doc_id; both null for an
    empty set."""
    base = written(sketches(rows, words), "sketches")
    classes = (base.where(F.col("cid").isNotNull()).groupBy("cid")
               .agg(F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "row_key")).alias("r"),
                    F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    classes = written(classes.select("cid", "first_doc", F.col("r.row_key").alias("row_key"), "n", "sketch"), "classes")
    pairs = written(pivot_pairs(index_rows(classes)), "pairs")
    listed = pairs.select("cid").unionByName(pairs.select(F.col("pivot").alias("cid"))).distinct()
    bitmap = bitmap_of(classes.join(listed, "cid").select("row_key"))
    sets = written(full_sets(rows, bitmap, words).join(listed, "cid", "left_semi").dropDuplicates(["cid"]), "sets")

    first = overlaps(pairs, sets, "cid", "pivot").withColumn("linked", is_link(F.col("both"), F.col("na"), F.col("nb")))
    first = written(first, "pivot-overlaps")
    members = first.select("pivot", "cid", F.col("na").cast("long").alias("n"),
                           F.col("both").cast("long").alias("shared"), "linked")
    more = overlaps(open_pairs(members, sets), sets, "a", "b")
    links = (first.where("linked").select(F.col("cid").alias("u"), F.col("pivot").alias("v"))
             .unionByName(more.where(is_link(F.col("both"), F.col("na"), F.col("nb")))
                          .select(F.col("a").alias("u"), F.col("b").alias("v"))))
    roots = connected_components(links)
    named = roots.join(classes.select(F.col("cid").alias("u"), "first_doc"), "u")
    of_root = named.groupBy("root").agg(F.min("first_doc").alias("least"))
    linked = named.join(of_root, "root").select(F.col("u").alias("cid"), "root", "least")
    names = (classes.select("cid", "first_doc").join(linked, "cid", "left")
             .select("cid", F.coalesce("root", "cid").alias("group"), F.coalesce("least", "first_doc").alias("name")))
    return base.select("doc_id", "row_key", "n", "cid").join(names, "cid", "left").drop("cid")


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty(F.col("text"))
    return docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), text).alias("row_key"), text.alias("text"))


def near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id,
    text): components of documents whose shingle sets have a Jaccard
    similarity of 0.8 or more."""
    return (_components(_keyed(docs), words)
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("name", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicated(docs: DataFrame, words: int = 5) -> DataFrame:
    """``docs`` (all its columns) with one row left of each component, that of
    the smallest doc_id; rows without shingles all stay."""
    found = _components(_keyed(docs), words)
    best = F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    stay = (found.where(F.col("n") > 0).groupBy("group").agg(best.alias("__key")).select("__key", F.lit(True).alias("__one"))
            .unionByName(found.where(F.col("n") == 0).select(F.col("row_key").alias("__key"), F.lit(False).alias("__one"))
                         .distinct()))
    keyed = docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("string"), text_or_empty(F.col("text"))))
    left = keyed.join(stay, "__key")
    one = left.where("__one").dropDuplicates(["__key"])
    return one.unionByName(left.where("NOT __one")).select(*docs.columns)
