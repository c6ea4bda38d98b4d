"""Centroid clustering over a vector approximation file.

Components become integers ``floor(256 * x)``. Beside each vector the file
holds its approximation: per dimension the number of the cell, of ``2**BITS``,
that the component lies in. Cell bounds are approximate quantiles between the
exact least and largest value of the dimension, so each cell's true range is
known and outliers cost precision only.

A pass over the file assigns every vector to its nearest centroid. For each
centroid, dimension and cell a lookup table has the least and the largest
squared distance of the cell from the centroid; their sums over the dimensions
bound the distance of a vector from above and below. Centroids whose interval
starts beyond the least upper end are out; a vector with one centroid left is
assigned by its cells alone. Only where intervals overlap are full vectors
fetched, and measured exactly against the centroids that are left. All bounds
are integers, so the assignment is that of exact distances, ties to the smaller
number.

The fetch is from the row's other column, in the same batch: the update needs
each vector once a round for the sums, so a table apart, joined by key, would
only add a shuffle. Tasks add up sums and counts per cluster; the driver gets
centroids x (dimensions + 1) numbers a round, whatever the number of vectors.

Vectors that are null, of another length, or hold null or non-finite entries
are left out, rows without an id too. Repeated rows and ids each count. Equal
hashes (repeated ids) among the first centroids are ordered by vector. With
fewer vectors than centroids each vector starts one; without any there are no
rows. Extra columns are ignored. Components must stay below 2**26 in size after
scaling, so that sums of squares are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import written
from mediapanel.llm.topk import quantised, usable

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
BITS = 6
SLICE = 2048  # vectors judged at once


def prepared(embeddings: DataFrame, dims: int) -> DataFrame:
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
            .where(usable(F.col("embedding")) & (F.size("embedding") == dims) & F.col("vec_id").isNotNull())
            .select("vec_id", quantised(F.col("embedding")).alias("v")))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes: a top-k, k rows to the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cell_bounds(vectors: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each cell (dimensions x cells)."""
    cells = 2 ** bits
    shares = [i / cells for i in range(1, cells)]
    rows = (vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d")
            .agg(F.min("x").alias("low"), F.max("x").alias("high"),
                 F.percentile_approx("x", shares, 2000).alias("cuts"))
            .orderBy("d").collect())
    starts = np.array([[r["low"], *[c + 1 for c in r["cuts"]]] for r in rows], np.int64)
    starts = np.minimum(np.maximum.accumulate(starts, axis=1), np.array([[r["high"]] for r in rows]))
    ends = np.c_[np.maximum(starts[:, 1:] - 1, starts[:, :-1]), [r["high"] for r in rows]]
    return starts, ends


def approximated(vectors: DataFrame, starts: np.ndarray) -> DataFrame:
    """(vec_id, cells, v): a byte per dimension holds the number of the cell."""
    dims = len(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dims)
            cells = np.empty(x.shape, np.uint8)
            for d in range(dims):
                cells[:, d] = np.searchsorted(starts[d], x[:, d], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _fixed(cells), batch.column("v")], names=["vec_id", "cells", "v"])

    return vectors.mapInArrow(run, "vec_id long, cells binary, v array<long>")


def _fixed(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


class Tables:
    """Lookup tables of the centroids: least and largest squared distance of
    every cell (dimensions x cells x centroids)."""

    def __init__(self, centroids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        c = centroids.T[:, None, :]
        below, above = starts[:, :, None] - c, c - ends[:, :, None]
        self.low = np.maximum(np.maximum(below, above), 0) ** 2
        self.high = np.maximum(np.abs(below), np.abs(above)) ** 2

    def intervals(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.low[0][cells[:, 0]]
        high = self.high[0][cells[:, 0]]
        for d in range(1, cells.shape[1]):
            low += self.low[d][cells[:, d]]
            high += self.high[d][cells[:, d]]
        return low, high


def nearest(centroids: np.ndarray, tables: Tables, cells: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest centroid of each vector, and how many vectors were fetched."""
    low, high = tables.intervals(cells)
    left = low <= high.min(axis=1, keepdims=True)
    cluster = left.argmax(axis=1)
    open_ = np.flatnonzero(left.sum(axis=1) > 1)
    if len(open_):
        row, c = np.nonzero(left[open_])
        distance = ((vectors[open_[row]] - centroids[c]) ** 2).sum(axis=1)
        # Rows are in order, centroids ascending within them: the first least one is the smaller number.
        best = np.lexsort((c, distance, row))
        cluster[open_] = c[best[np.searchsorted(row, np.arange(len(open_)))]]
    return cluster, len(open_)


def _pieces(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for i in range(0, batch.num_rows, SLICE):
        part = batch.slice(i, SLICE)
        cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dims)
        yield part, cells, _matrix(part, dims)


def moved(file: DataFrame, centroids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after one round, and how many vectors were fetched in it."""
    k, dims = centroids.shape
    slots = dims + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(centroids, starts, ends)
        total, fetched = np.zeros((k, slots), np.int64), 0
        for batch in batches:
            for _, cells, vectors in _pieces(batch, dims):
                cluster, n = nearest(centroids, tables, cells, vectors)
                order = np.argsort(cluster, kind="stable")
                at = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                total[cluster[order[at]], :dims] += np.add.reduceat(vectors[order], at, axis=0)
                total[:, dims] += np.bincount(cluster, minlength=k)
                fetched += n
        used = np.flatnonzero(total[:, dims])
        slot = (used[:, None] * slots + np.arange(slots)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[slot, -1]), pa.array(np.r_[total[used].ravel(), fetched])],
                                         names=["slot", "total"])

    rows = file.select("cells", "v").mapInArrow(run, "slot long, total long").groupBy("slot").agg(
        F.sum("total").alias("total")).toArrow()
    sums = dict(zip(rows.column("slot").to_pylist(), rows.column("total").to_pylist()))
    out = centroids.copy()
    for c in range(k):
        if count := sums.get(c * slots + dims, 0):
            out[c] = [sums[c * slots + d] // count for d in range(dims)]
    return out, sums.get(-1, 0)


def assigned(file: DataFrame, centroids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(centroids, starts, ends)
        for batch in batches:
            for part, cells, vectors in _pieces(batch, dims):
                cluster, _ = nearest(centroids, tables, cells, vectors)
                distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return file.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(embeddings: DataFrame, dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS,
            seed: int = SEED, bits: int = BITS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) and the final centroids."""
    rows = prepared(embeddings, dims)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    starts, ends = cell_bounds(rows, bits)
    file = written(approximated(rows, starts), "va-file")
    for _ in range(rounds):
        centroids, _ = moved(file, centroids, starts, ends)
    return assigned(file, centroids, starts, ends), centroids


def clustered_embeddings(embeddings: DataFrame, dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS,
                         seed: int = SEED) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    found, centroids = cluster(embeddings, dims, k, rounds, seed)
    found = written(found, "va-clusters")
    names = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.sum("distance").alias("inertia"))
    spark = embeddings.sparkSession
    # At most k rows each, so they are broadcast.
    hashes = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    return (found.join(F.broadcast(per), "cluster").join(F.broadcast(hashes), "cluster")
            .join(F.broadcast(whole)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
