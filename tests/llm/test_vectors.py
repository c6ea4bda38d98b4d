"""Whitening and centroid clustering of vectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediapanel.llm import va_cluster, whitening

COMPONENTS = 16


def vectors(spark, rows):
    return (spark.createDataFrame(rows, "vec_id long, embedding array<float>")
            .withColumns({"x": F.lit("clash"), "n": F.lit(1), "component": F.lit(2), "cluster": F.lit(3), "v": F.lit("v")})
            .repartition(3))


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def plain_whitening(rows, components=COMPONENTS):
    rows = usable(rows)
    dims = max(len(v) for _, v in rows)
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = (n * fit - sums) / n
    values, vecs = np.linalg.eigh(z.T @ z / n)
    return [i for i, _ in rows], x, n, sums, values[::-1], vecs[:, ::-1]


def check_whitening(df, rows, components=COMPONENTS, tolerance=1e-8):
    ids, x, n, sums, values, vecs = plain_whitening(rows, components)
    rank = int((values[:components] > 1e-10 * values[0]).sum())
    got = df.toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == len(ids) * rank
    assert (got["n"] == n).all() and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    far = {}
    for i, row in zip(ids, x):
        far.setdefault(i, []).append(row)
    for (i, c), part in got.groupby(["vec_id", "component"], dropna=False):
        held = far[None if i != i else i]
        assert sorted(part["deviation"]) == sorted(sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in held)
        np.testing.assert_allclose(part["explained"], values[c - 1] / values.sum(), rtol=1e-9)
    # By component, up to its sign.
    one = {i: r[0] for i, r in far.items() if len(r) == 1 and i is not None}
    for c, part in got[got["vec_id"].isin(list(one))].groupby("component"):
        want = np.array([((n * one[i] - sums) / n) @ vecs[:, c - 1] for i in part["vec_id"]]) / np.sqrt(values[c - 1])
        have = part["whitened"].to_numpy()
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < tolerance


def random_rows(rng, n, dims, spread):
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.normal(0, 1, (n, dims)) * spread)]


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = random_rows(rng, 300, 12, np.linspace(3, 0.5, 12))
    rows += [(i, rows[0][1]) for i in range(1000, 1200)]                  # one vector in many rows: fitted once
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[3][1]), (2000, [0.5] * 5), (2001, [])]
    rows += [(3000, None), (3001, [None] + [0.0] * 11), (3002, [float("nan")] * 12), (3003, [float("-inf")] + [0.0] * 11)]
    check_whitening(whitening.whiten(vectors(spark, rows)), rows)


@pytest.mark.parametrize("spread", [
    np.full(80, 2.0),                                             # no gap anywhere
    np.r_[[300.0, 60.0], np.full(78, 2.0)],                       # two directions over a flat rest
    np.geomspace(40, 0.2, 80)])
def test_whitening_by_the_filter(spark, spread, monkeypatch):
    monkeypatch.setattr(whitening, "EXTRA", 8)
    rng = np.random.default_rng(4)
    rows = random_rows(rng, 500, 80, spread)
    check_whitening(whitening.whiten(vectors(spark, rows)), rows, tolerance=1e-7)


class Matrix:
    """The covariance as a plain matrix."""

    def __init__(self, v):
        self.v, self.count = v, 0

    def times(self, block):
        self.count += 1
        return self.v @ block


@pytest.mark.parametrize("values", [
    np.r_[np.full(30, 5.0), np.full(70, 4.999)], np.r_[1e6, np.full(99, 1.0)], np.r_[np.full(20, 3.0), np.zeros(80)],
    np.linspace(2, 1, 100), np.geomspace(1, 1e-12, 100), np.zeros(100)])
def test_leading_pairs_are_certified(values):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((100, 100)))[0]
    v = (q * values) @ q.T
    got, vecs = whitening.leading_pairs(Matrix((v + v.T) / 2), 100, 16)
    top = max(values[0], 1e-300)
    np.testing.assert_allclose(got / top, values[:16] / top, atol=1e-9)
    assert np.abs(vecs.T @ vecs - np.eye(16)).max() < 1e-12
    assert np.abs(v @ vecs - vecs * got).max() <= 1e-9 * top


def test_a_missed_direction_is_found_by_the_probe():
    """A start that has nothing of the largest eigenvector."""
    values = np.r_[10.0, np.linspace(5, 1, 99)]
    v = np.diag(values)
    q = np.eye(100)[:, 1:41]
    probe = whitening._probe(Matrix(v), q, values[1:41], 16, 0.0, np.random.default_rng(0))
    assert probe is not None and abs(probe[0]).max() > 0.9
    assert whitening._probe(Matrix(v), np.eye(100)[:, :40], values[:40], 16, 0.0, np.random.default_rng(0)) is None


def test_whitening_of_small_tables(spark):
    none = vectors(spark, [(1, [0.5])]).limit(0)
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.1]), (2, [0.5, 0.1])])).count() == 0  # no variance
    two = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    got = whitening.whiten(vectors(spark, two)).orderBy("vec_id").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9), round(r.explained, 9)) for r in got] == [
        (1, 1, 2, 64 ** 2, 1.0, 1.0), (2, 1, 2, 64 ** 2, 1.0, 1.0), (2, 1, 2, 64 ** 2, 1.0, 1.0)]


def plain_clusters(rows, dims, k, rounds, seed=2):
    rows = sorted(((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), [int(np.floor(256 * float(x))) for x in v], i)
                   for i, v in usable(rows) if i is not None and len(v) == dims), key=lambda r: (r[0], r[1]))
    x = [v for _, v, _ in rows]
    centroids = [list(v) for v in x[:k]]

    def judge(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for v in x:
            groups.setdefault(judge(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = [sum(col) // len(g) for col in zip(*g)]
    out = [(i, judge(v)) for _, v, i in rows]
    inertia = {}
    for _, (d, j) in out:
        inertia[j] = inertia.get(j, 0) + d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, (d, j) in out)


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_clusters_match_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(va_cluster, "BITS", bits)
    monkeypatch.setattr(va_cluster, "SLICE", 17)
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.1, 8)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(i, rows[5][1]) for i in range(500, 640)]                                # a third: one vector
    rows += [(3, rows[9][1]), (3, rows[9][1]), (700, [1000.0] + [0.0] * 7), (701, [-3.0] * 8)]
    rows += [(800, None), (801, [0.0] * 7), (802, [None] * 8), (803, [float("nan")] * 8), (None, [0.0] * 8)]
    df = va_cluster.cluster(vectors(spark, rows), 8, 9, 4, bits=bits)[0]
    want = plain_clusters(rows, 8, 9, 4)
    assert sorted(tuple(r) for r in df.select("vec_id", "cluster", "distance").collect()) == sorted(w[:3] for w in want)
    got = va_cluster.clustered_embeddings(vectors(spark, rows), 8, 9, 4)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_cells_decide_without_the_vector():
    """Far groups: the intervals alone tell nearly all vectors apart."""
    rng = np.random.default_rng(7)
    centres = rng.integers(-1000, 1000, (5, 16))
    x = centres[rng.integers(0, 5, 2000)] + rng.integers(-20, 21, (2000, 16))
    cuts = np.quantile(x, np.arange(1, 64) / 64, axis=0).astype(np.int64).T
    starts = np.minimum(np.maximum.accumulate(np.c_[x.min(axis=0), cuts + 1], axis=1), x.max(axis=0)[:, None])
    ends = np.c_[np.maximum(starts[:, 1:] - 1, starts[:, :-1]), x.max(axis=0)]
    cells = np.stack([np.searchsorted(starts[d], x[:, d], "right") - 1 for d in range(16)], axis=1).astype(np.uint8)
    tables = va_cluster.Tables(centres, starts, ends)
    low, high = tables.intervals(cells)
    exact = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()
    cluster, fetched = va_cluster.nearest(centres, tables, cells, x)
    assert (cluster == exact.argmin(axis=1)).all() and fetched < 20


def test_clusters_of_small_tables(spark):
    assert va_cluster.clustered_embeddings(vectors(spark, [(1, [0.5])]).limit(0)).count() == 0
    assert va_cluster.clustered_embeddings(vectors(spark, [(1, [0.5]), (2, None)])).count() == 0
    few = [(1, [0.5, 0.25]), (2, [0.0, -1.0]), (3, [0.5, 0.25])]
    got = va_cluster.clustered_embeddings(vectors(spark, few), 2, 40, 5)
    assert sorted(tuple(r) for r in got.collect()) == plain_clusters(few, 2, 40, 5)
