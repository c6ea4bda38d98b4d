"""Exact top-k search over a bit-sliced index.

Vector components become integers ``floor(256 * x)``. Rows are dealt into
blocks; a block stores, per dimension, the bit slices of its (offset,
non-negative) values as bitmaps over its rows. For a query, the slices of each
dimension are added into a bit-sliced sum, shifted by the set bits of the
query's component; where the component is negative the complemented slices are
added instead, which differs from the true product by a constant of the block.
The top rows are then selected from the sum's most significant slice downward:
rows that are surely in, and rows that still tie, are kept as bitmaps. The
ties left after the last slice are the boundary rows; they are resolved
exactly by the smaller vec_id.

Query blocks meet index blocks one pair per task group, so memory is bounded
by two blocks whatever the table sizes. Every pair yields at most k rows per
query, and the k best of all blocks are kept.

Vectors that are null, or hold null or non-finite components, take no part.
Vectors of other lengths than a query's count as padded with zeros. A row is
the query's own if it has the query's vec_id; a null vec_id is a candidate
never returned before others, and no query. Repeated candidate rows count once
each. Components must stay below 2**31 in size after scaling.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 256
BLOCK_ROWS = 8192
QUERY_ROWS = 512


def quantised(vec: Column) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(vectors) -> np.ndarray:
    vectors = [np.asarray(v, np.int64) for v in vectors]
    out = np.zeros((len(vectors), max([1, *map(len, vectors)])), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def slice_block(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit slices of the rows of ``values`` (rows x dims) minus their least
    value: (dims, bits, words of 64 rows), and that least value."""
    low = int(values.min())
    shifted = (values - low).astype(np.uint64)
    bits = max(1, int(shifted.max()).bit_length())
    rows, dims = values.shape
    words = -(-rows // 64)
    padded = np.zeros((words * 64, dims), np.uint64)
    padded[:rows] = shifted
    slices = np.empty((dims, bits, words), np.uint64)
    for b in range(bits):
        on = np.ascontiguousarray(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T)
        slices[:, b] = np.packbits(on, axis=1, bitorder="little").view(np.uint64)
    return slices, low


def sum_slices(queries: np.ndarray, slices: np.ndarray, low: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Slices (least significant first, queries x words) of a non-negative sum
    per query and row; score = sum - constant of the query."""
    dims, bits, words = slices.shape
    n = len(queries)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    total: list[np.ndarray] = []
    top = (1 << bits) - 1
    const = np.zeros(n, object)
    for d in range(dims):
        q = queries[:, d] if d < queries.shape[1] else np.zeros(n, np.int64)
        negative, size = q < 0, np.abs(q)
        # score part q * (u + low); for q < 0 the slices hold top - u instead
        const += np.where(negative, size.astype(object) * (top + low), -size.astype(object) * low)
        flip = np.where(negative, full, np.uint64(0))[:, None]
        for j in range(int(size.max()).bit_length() if n else 0):
            on = np.where((size >> j) & 1, full, np.uint64(0))[:, None]
            if not on.any():
                continue
            carry: np.ndarray | None = None
            b = 0
            while b < bits or carry is not None:
                while len(total) <= j + b:
                    total.append(np.zeros((n, words), np.uint64))
                acc = total[j + b]
                if b < bits:
                    add = (slices[d, b][None, :] ^ flip) & on
                    half = acc ^ add
                    both = acc & add
                    if carry is None:
                        acc[...], carry = half, both
                    else:
                        acc[...] = half ^ carry
                        carry = both | (half & carry)
                else:
                    both = acc & carry
                    acc ^= carry
                    carry = both if both.any() else None
                b += 1
    return total, const


def select_top(total: list[np.ndarray], allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query, the rows surely among the k largest sums and the rows that
    tie for the places left, as bitmaps (queries x words)."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    have = count(sure)
    for s in reversed(total):
        ones = tied & s
        n = count(ones)
        fits = (have + n <= k)[:, None]  # all rows with this bit are in; else only they go on
        sure |= np.where(fits, ones, np.uint64(0))
        tied = np.where(fits, tied & ~s, ones)
        have += np.where(fits[:, 0], n, 0)
    return sure, tied


def _rows_of(bitmaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(bitmaps.view(np.uint8), axis=1, bitorder="little")
    return np.nonzero(bits)


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray,
                 slices: np.ndarray, low: int, k: int) -> pd.DataFrame:
    """Up to k best rows of one index block for each query of one query block.
    ``ids`` are ascending; they break the ties of the boundary."""
    n, rows, words = len(query_ids), len(ids), slices.shape[2]
    total, const = sum_slices(queries, slices, low)
    valid = np.zeros(words * 64, np.uint8)
    valid[:rows] = 1
    allowed = np.repeat(np.packbits(valid, bitorder="little").view(np.uint64)[None, :], n, axis=0)
    first, last = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for i in np.flatnonzero(last > first):
        for r in range(first[i], last[i]):
            allowed[i, r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
    sure, tied = select_top(total, allowed, k)
    qs, rs = _rows_of(sure)
    qt, rt = _rows_of(tied)  # in row order, so by vec_id
    place = np.arange(len(qt)) - np.searchsorted(qt, qt, "left")
    in_ = place < (k - np.bincount(qs, minlength=n))[qt]
    qi, ri = np.concatenate([qs, qt[in_]]), np.concatenate([rs, rt[in_]])
    word, bit = ri // 64, (ri % 64).astype(np.uint64)
    sums = np.zeros(len(qi), object)
    for b, s in enumerate(total):
        sums += ((s[qi, word] >> bit) & np.uint64(1)).astype(object) << b
    score = sums - const[qi] if len(qi) else sums
    return pd.DataFrame({"query_id": query_ids[qi], "vec_id": ids[ri], "score": score.astype(np.int64)})


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """(block, ids, dims, bits, low, slices): one row per block."""
    def build(key, pdf):
        pdf = pdf.sort_values("vec_id", kind="stable")
        slices, low = slice_block(_matrix(pdf["v"]))
        return pd.DataFrame({"block": [key[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "dims": [slices.shape[0]], "bits": [slices.shape[1]], "low": [low],
                             "slices": [slices.tobytes()]})

    # A hash of id and vector: repeated ids or vectors alone make no large block.
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(
        build, "block int, ids binary, dims int, bits int, low long, slices binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k largest integer inner products per query (query_id, rank, vec_id,
    score), ties to the smaller vec_id. Both frames hold (vec_id, embedding)."""
    if k < 1:
        raise ValueError("k must be at least 1")

    def prepared(df: DataFrame) -> DataFrame:
        return (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
                .where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
                .select("vec_id", quantised(F.col("embedding")).alias("v")))

    base, asked = prepared(vectors), prepared(queries).dropDuplicates(["vec_id", "v"])
    n_rows, n_queries = base.count(), asked.count()
    blocks, groups = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    index = build_index(base, blocks)
    packed = (asked.withColumn("qgroup", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    # One copy of an index block per query group: the pairs of blocks.
    index = index.withColumn("qgroup", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def pair(left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64),
                                 "score": np.zeros(0, np.int64)})
        x = left.iloc[0]
        ids = np.frombuffer(x["ids"], np.int64)
        slices = np.frombuffer(x["slices"], np.uint64).reshape(x["dims"], x["bits"], -1)
        return search_block(right["vec_id"].to_numpy(np.int64), _matrix(right["v"]), ids, slices,
                            int(x["low"]), k)

    found = (index.groupBy("block", "qgroup").cogroup(packed.groupBy("block", "qgroup"))
             .applyInPandas(pair, "query_id long, vec_id long, score long"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k_of_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The stated query set: rows whose vec_id is divisible by ``every``."""
    return top_k(embeddings, embeddings.where(F.col("vec_id") % every == 0), k)
