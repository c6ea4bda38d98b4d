"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(64 * c) + 1000000``. The covariance V of
the distinct vectors (divisor n, centred before multiplying) is never formed:
a pass over the written fit list multiplies it with a block, each task adding
up ``Z' (Z Q)`` over its centred rows Z and the tasks' sums being added by
cell. A block of ``components + EXTRA`` orthonormal columns is improved
until its leading Ritz pairs are certified:

1. one pass gives ``V Q``; Rayleigh-Ritz turns Q into Ritz vectors,
2. the three-term Chebyshev recurrence applies a polynomial of V that is small
   on the unwanted spectrum, from below the least eigenvalue (a Lanczos run
   that rides along in the first passes bounds it) to the block's least Ritz
   value, and grows beyond; its degree is limited so that the largest growth
   does not drown the smallest wanted one in rounding,
3. QR, and again from 1.

Certified means: every wanted pair has a residual of ``TOL`` of the largest
eigenvalue (or has stopped improving below ``FLOOR``), and a fresh random
block, kept orthogonal to the found one and filtered towards the top of what is
left, shows no Ritz value above the last wanted one; if it does, it joins the
block. A block that does not get there in ``ROUNDS`` doubles; one as wide as the
vectors needs a single Rayleigh-Ritz step.

The driver holds matrices of dimensions x block, whatever the number of rows.
Rows with a null vector, or null or non-finite entries, are dropped. Shorter
vectors count as padded with c = 0. Repeated rows and ids are each reported; a
null id is kept. Components whose eigenvalue is zero (below ``RANK_TOL`` of the
largest) cannot be whitened and are left out, so a table without two different
vectors, or without rows, gives no rows. Entries have to stay below 2**40 after
scaling; a deviation that does not fit a long is an error. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import written
from mediapanel.llm.topk import usable

SCALE, OFFSET = 64, 1_000_000
EXTRA = 24            # columns of the block beyond the wanted ones
PROBE = 4             # columns of the certifying block
LANCZOS = 12          # steps of the run that bounds the least eigenvalue
DEGREE = 16           # of the polynomial, at most
GROWTH = 1e10         # most that the largest eigenvalue may outgrow the last wanted one in one round
ROUNDS = 40
TOL, FLOOR = 2e-15, 1e-11
RANK_TOL = 1e-13


@dataclass
class Whitening:
    n: int
    sums: np.ndarray        # exact, per dimension
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # dimensions x components
    trace: float
    passes: int


def quantised(vec: Column) -> Column:
    return F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))


def prepared(embeddings: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows, all of one length, and that length."""
    rows = (embeddings.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("c"))
            .where(usable(F.col("c"))))
    dims = rows.agg(F.max(F.size("c"))).first()[0] or 0
    x = quantised(F.col("c"))
    return rows.select("vec_id", F.concat(x, F.array_repeat(F.lit(OFFSET).cast("long"), dims - F.size("c"))).alias("x")), dims


def _rows(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _added(fit: DataFrame, part: Callable[[Iterator[np.ndarray]], np.ndarray], rows: int, width: int,
           dims: int, kind: str = "double") -> np.ndarray:
    """Matrices (rows x width) that the tasks make of their vectors, added up
    by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(_rows(b, "x", dims) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows * width)), pa.array(total.ravel())],
                                         names=["at", "value"])

    summed = (fit.select("x").mapInArrow(run, f"at long, value {kind}")
              .groupBy("at").agg(F.sum("value").alias("value")).toArrow())
    out = np.zeros(rows * width, np.int64 if kind == "long" else np.float64)
    out[summed.column("at").to_numpy()] = summed.column("value").to_numpy()
    return out.reshape(rows, width)


def sums_of(fit: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums per dimension."""
    def part(blocks):
        total = np.zeros(dims + 1, np.int64)
        for x in blocks:
            total[:-1] += (x - OFFSET).sum(axis=0)
            total[-1] += len(x)
        return total[:, None]

    total = _added(fit, part, dims + 1, 1, dims, "long")[:, 0]
    n = int(total[-1])
    return n, total[:-1] + n * OFFSET


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


class Passes:
    """Products of the covariance with blocks; one pass over the fit list each."""

    def __init__(self, fit: DataFrame, n: int, sums: np.ndarray):
        self.fit, self.n, self.sums, self.count = fit, n, sums, 0

    def times(self, block: np.ndarray) -> np.ndarray:
        n, sums, (dims, width) = self.n, self.sums, block.shape
        self.count += 1

        def part(blocks):
            total = np.zeros((dims, width))
            for x in blocks:
                z = centred(x, n, sums)
                total += z.T @ (z @ block)
            return total

        return _added(self.fit, part, dims, width, dims) / n

    def trace(self) -> float:
        n, sums, dims = self.n, self.sums, len(self.sums)

        def part(blocks):
            return np.array([[sum(float((centred(x, n, sums) ** 2).sum()) for x in blocks)]])

        return float(_added(self.fit, part, 1, 1, dims)[0, 0]) / n

    def second_moments(self, project: np.ndarray) -> np.ndarray:
        """Covariance of the projected rows."""
        n, sums, (dims, width) = self.n, self.sums, project.shape

        def part(blocks):
            total = np.zeros((width + 1, width))
            for x in blocks:
                w = centred(x, n, sums) @ project
                total[:-1] += w.T @ w
                total[-1] += w.sum(axis=0)
            return total

        total = _added(self.fit, part, width + 1, width, dims) / n
        return total[:-1] - np.outer(total[-1], total[-1])


class LeastEigenvalue:
    """Lanczos steps on a vector that rides along with other products."""

    def __init__(self, dims: int, rng: np.random.Generator):
        v = rng.standard_normal(dims)
        self.basis, self.alpha, self.beta = [v / np.linalg.norm(v)], [], []

    def wants(self) -> bool:
        return len(self.alpha) < min(LANCZOS, len(self.basis[0])) and len(self.basis) > len(self.alpha)

    def step(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ product))
        for _ in range(2):
            for b in self.basis:
                product = product - b * (b @ product)
        size = float(np.linalg.norm(product))
        self.beta.append(size)
        if size > 1e-10 * max(map(abs, self.alpha)):
            self.basis.append(product / size)

    def bound(self) -> float:
        """Least Ritz value minus its residual, not below zero."""
        k = len(self.alpha)
        if not k:
            return 0.0
        t = np.diag(self.alpha) + np.diag(self.beta[:k - 1], 1) + np.diag(self.beta[:k - 1], -1)
        values, vectors = np.linalg.eigh(t)
        return max(0.0, float(values[0] - 2 * self.beta[k - 1] * abs(vectors[-1, 0])))


def _growth(x: float, low: float, high: float) -> float:
    """Rate at which the polynomials on [low, high] grow at x, per degree."""
    return math.acosh(max(1.0, (2 * x - low - high) / (high - low)))


def _filtered(times, q: np.ndarray, vq: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V on [low, high] times ``q``; ``vq``
    is V times q. Scaled to 1 at ``top``, so nothing overflows."""
    half, mid = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - mid)
    before, now = q, (vq - mid * q) * (sigma / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - sigma)
        before, now = now, (times(now) - mid * now) * (2 * nxt / half) - before * (sigma * nxt)
        sigma = nxt
    return now


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors, their products with V, residual norms."""
    t = q.T @ vq
    values, s = np.linalg.eigh((t + t.T) / 2)
    values, s = values[::-1], s[:, ::-1]
    q, vq = q @ s, vq @ s
    return values, q, vq, np.linalg.norm(vq - q * values, axis=0)


def leading_pairs(passes: Passes, dims: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and their vectors."""
    rng = np.random.default_rng(seed)
    width = min(dims, wanted + EXTRA)
    q = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    least = LeastEigenvalue(dims, rng)

    def times(block: np.ndarray) -> np.ndarray:
        if least.wants():
            out = passes.times(np.c_[block, least.basis[-1]])
            least.step(out[:, -1])
            return out[:, :-1]
        return passes.times(block)

    rounds, worst = 0, math.inf
    while True:
        values, q, vq, residual = _ritz(q, times(q))
        top = float(values[0])
        if top <= 0 or q.shape[1] == dims:
            return values[:wanted], q[:, :wanted]
        # What a residual says about pairs whose eigenvalue is zero is rounding.
        now = float(residual[:wanted].max()) / top
        stalled = now <= FLOOR and now > worst / 2
        worst = min(worst, now)
        if now <= TOL or stalled:
            probe = _probe(passes, q, values, wanted, least.bound(), rng)
            if probe is None:
                return values[:wanted], q[:, :wanted]
            q, worst = np.linalg.qr(np.c_[q, probe][:, :dims])[0], math.inf
            continue
        rounds += 1
        if rounds % ROUNDS == 0:
            more = rng.standard_normal((dims, min(dims, 2 * q.shape[1]) - q.shape[1]))
            q, worst = np.linalg.qr(np.c_[q, more])[0], math.inf
            continue
        low, high = least.bound(), float(values[-1])
        if high - low <= 1e-9 * top:
            low, high = 0.0, max(high, 1e-9 * top)
        spread = _growth(top, low, high) - _growth(float(values[wanted - 1]), low, high)
        degree = min(DEGREE, max(2, int(math.log(GROWTH) / max(spread, 1e-9))))
        q = np.linalg.qr(_filtered(times, q, vq, degree, low, high, top * (1 + 1e-12) + 1e-300))[0]


def _probe(passes: Passes, q: np.ndarray, values: np.ndarray, wanted: int, low: float,
           rng: np.random.Generator) -> np.ndarray | None:
    """None if a fresh block beside ``q`` shows nothing above the last wanted
    value, else that block."""
    dims = len(q)

    def out(p: np.ndarray) -> np.ndarray:
        for _ in range(2):
            p = p - q @ (q.T @ p)
        return p

    p = np.linalg.qr(out(rng.standard_normal((dims, min(PROBE, dims - q.shape[1])))))[0]
    high = float(values[wanted - 1])
    if high <= low:
        low = 0.0
    if high <= 0:
        return None
    p = _filtered(lambda b: out(passes.times(b)), p, out(passes.times(p)), 6, low, high, high * 1.01)
    p = np.linalg.qr(out(p))[0]
    found = _ritz(p, out(passes.times(p)))[0]
    return p if found[0] > high * (1 + 1e-9) else None


def fit_whitening(vectors: DataFrame, dims: int, components: int = 16) -> tuple[Whitening, Passes] | None:
    """Fit on the distinct vectors ``x`` of ``vectors``; None without any."""
    if not dims:
        return None
    # Map-side distinct first, so a vector that many rows share is shipped once a task.
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    if fit.isEmpty():
        return None
    n, sums = sums_of(fit, dims)
    passes = Passes(fit, n, sums)
    values, q = leading_pairs(passes, dims, min(components, dims))
    keep = values > RANK_TOL * max(float(values[0]), 0.0)
    return Whitening(n, sums, values[keep], q[:, keep], passes.trace(), passes.count), passes


def whiten(embeddings: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    rows, dims = prepared(embeddings, id_col, vec_col)
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    fitted = fit_whitening(rows, dims, components)
    if fitted is None or not len(fitted[0].values):
        return embeddings.sparkSession.createDataFrame([], schema)
    model, passes = fitted
    n, sums = model.n, model.sums
    project = model.vectors / np.sqrt(model.values)
    width = project.shape[1]
    identity_error = float(np.abs(passes.second_moments(project) - np.eye(width)).max())
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 4096) for i in range(0, whole.num_rows, 4096)):
                x = _rows(batch, "x", dims)
                far = n * x - sums
                if len(far) and float((far.astype(float) ** 2).sum(axis=1).max()) > 2.0 ** 62:
                    raise OverflowError("a deviation does not fit a long")
                whitened, count = (far / n) @ project, len(x) * width
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), width))),
                     pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(count, n, np.int64)), pa.array(np.repeat((far ** 2).sum(axis=1), width)),
                     pa.array(whitened.ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(count, identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
