"""Whitening of embeddings by a block Jacobi-Davidson method; the covariance matrix is never formed.

A product of the covariance with a block of vectors is one Spark job: each task multiplies its centred rows, and the
sums of all tasks meet by dimension, so the driver gets as many numbers as the block has.  Ritz pairs of a small search
space give the residuals; those that have reached double precision are locked, from the first on.  For the others the
projected correction equation is solved by a few steps of MINRES, all of them in step, so an inner step is one product
for the whole block.  The corrections join the search space, which is restarted from its best vectors when it is full.

Vectors are whole numbers (`quantised` makes them), so their number, sums and deviations are exact.  They are centred
before anything is multiplied: by the nearest whole mean first, then by the rest of it.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are left out; vectors of different
lengths, or whole numbers beyond 2^53, are an error; components without variance (up to rounding) don't exist, so equal
vectors, or none, give no row; equal eigenvalues have some orthonormal basis of their space; repeated ids keep a row
each; other columns aren't carried.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.llm.common import quoted, tidy, written

#: Components, vectors of the search space at most, inner and outer steps at most.
COMPONENTS, SPACE, INNER, OUTER = 32, 128, 8, 60
#: A residual has reached double precision at so many roundings of the largest eigenvalue, times the root of the dimension.
ROUNDINGS = 32
#: The columns of a block are filled up to a multiple of this, so that few plans are compiled.
WIDTH = 8
EPS = float(np.finfo(float).eps)


class Fit(NamedTuple):
    n: int
    sums: list[int]
    values: np.ndarray  # falling
    vectors: np.ndarray  # a column each
    trace: float
    residual: float
    error: float  # of the whitened covariance against the identity


def quantised(df: DataFrame, vector: str, scale: float, shift: int) -> DataFrame:
    """Rows whose vector has finite entries only, as x: floor(scale * entry) + shift."""
    entries = quoted(vector).cast("array<double>")
    usable = (F.size(entries) > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.where(F.coalesce(usable, F.lit(False))).withColumn("x", F.transform(entries, lambda c: F.floor(c * scale).cast("bigint") + shift))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)


class Rows:
    """The fit list as a written table of x, with its exact sums."""

    def __init__(self, vectors: DataFrame):
        self.table = vectors
        spread = vectors.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x")), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))).first()
        self.n, self.d, longest, largest = spread[0], spread[1] or 0, spread[2] or 0, spread[3] or 0
        if self.d != longest or largest > 1 << 53:
            raise ValueError(f"vectors of {self.d} to {longest} entries, up to {largest}")
        self.sums = [int(s) for s in self.summed(lambda x: x.sum(axis=0)[:, None], 1, np.int64)[:, 0]] if self.n else []
        #: The mean, as whole numbers and what is left of it.
        self.whole = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.whole, strict=True)])

    def summed(self, f, width: int, kind=np.float64) -> np.ndarray:
        """The sum over all tasks of f (rows of x -> a matrix with `width` columns), by the rows of that matrix."""
        d, columns = self.d, [f"c{j}" for j in range(-(-width // WIDTH) * WIDTH if width > 1 else 1)]

        def run(batches):
            total = None
            for batch in batches:
                part = f(matrix(batch.column(0), d))
                total = part if total is None else total + part
            if total is not None:
                wide = np.zeros((len(total), len(columns)), kind)
                wide[:, :width] = total
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *(pa.array(np.ascontiguousarray(wide[:, j])) for j in range(len(columns)))], names=["i", *columns])

        sql = "bigint" if kind is np.int64 else "double"
        sums = self.table.select("x").mapInArrow(tidy(run), "i bigint, " + ", ".join(f"{c} {sql}" for c in columns)).groupBy("i").agg(*(F.sum(c).alias(c) for c in columns))
        rows = sorted(sums.collect())  # as many as there are dimensions
        return np.array([r[1 : 1 + width] for r in rows], kind).reshape(len(rows), width)

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of column vectors."""
        n, whole, rest = self.n, self.whole, self.rest

        def f(x):
            y = (x - whole) - rest
            return y.T @ (y @ block)

        return self.summed(f, block.shape[1]) / n

    def trace(self) -> float:
        whole, rest = self.whole, self.rest
        return float(self.summed(lambda x: (((x - whole) - rest) ** 2).sum(axis=0)[:, None], 1).sum() / self.n)


def outside(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """block without its parts in the bases (of orthonormal columns), as orthonormal columns; what vanishes is dropped."""
    out = []
    basis = np.concatenate(bases, axis=1)
    for column in block.T:
        before = size = np.linalg.norm(column)
        for _ in range(3):
            for part in (basis, np.array(out).T) if out else (basis,):
                column = column - part @ (part.T @ column)
            if (now := np.linalg.norm(column)) > 0.7 * size:
                break
            size = now
        if before > 0 and now > 1e-10 * before:
            out.append(column / now)
    return np.array(out).T if out else np.empty((len(block), 0))


def minres(product, shifts: np.ndarray, right: np.ndarray, project, goal: float, steps: int) -> np.ndarray:
    """Solves P (V - shift) P t = right of each column, with the products of all columns in one block.

    Lanczos vectors, one rotation a step; a column rests once its residual has fallen below goal times its first.
    """
    size = np.linalg.norm(right, axis=0)
    size[size == 0] = 1
    v, old, beta = right / size, np.zeros_like(right), np.zeros_like(size)
    left = first = size.copy()
    c, s, c_old, s_old = np.ones_like(size), np.zeros_like(size), np.ones_like(size), np.zeros_like(size)
    w, w_old, out = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    busy = np.ones(len(size), bool)
    for _ in range(steps):
        if not busy.any():
            break
        p = project(product(v) - v * shifts)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * old
        beta_next = np.linalg.norm(p, axis=0)
        # The column (beta, alpha, beta_next) of the tridiagonal matrix, under the last two rotations and a new one.
        far, mid = s_old * beta, c_old * beta
        near, diagonal = c * mid + s * alpha, c * alpha - s * mid
        size_now = np.hypot(diagonal, beta_next)
        size_now[size_now == 0] = 1
        c_new, s_new = diagonal / size_now, beta_next / size_now
        w_new = (v - near * w - far * w_old) / size_now
        out = out + np.where(busy, c_new * left, 0) * w_new
        left = np.where(busy, -s_new * left, left)
        busy &= (np.abs(left) > goal * first) & (beta_next > EPS * np.abs(shifts).max())
        old, v = v, p / np.where(beta_next > 0, beta_next, 1)
        w_old, w, beta, c_old, s_old, c, s = w, w_new, beta_next, c, s, c_new, s_new
    return out


def jacobi_davidson(product, d: int, k: int, space: int = SPACE, inner: int = INNER, outer: int = OUTER, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues of a symmetric map, their vectors and the largest residual.

    product: a block of columns -> its image.  The residual is checked with a product of its own at the end.
    """
    k, space = min(k, d), max(space, 2 * min(k, d) + WIDTH)
    locked, none = np.empty((d, 0)), np.empty((d, 0))
    values: list[float] = []
    basis = outside(np.random.default_rng(seed).standard_normal((d, k)), none)
    image = product(basis)
    for step in range(outer):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        want = k - locked.shape[1]
        ritz, ritz_image = basis @ turn, image @ turn
        residual = ritz_image[:, :want] - ritz[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        top = max([*values, *np.abs(theta[:1])], default=0)
        done = norms <= ROUNDINGS * EPS * top * np.sqrt(d)
        n_done = int(np.argmin(done)) if not done.all() else len(done)
        if n_done:  # in order, so that none is passed over
            locked = np.concatenate([locked, ritz[:, :n_done]], axis=1)
            values += theta[:n_done].tolist()
        if locked.shape[1] == k:
            break
        # What stays is a basis of Ritz vectors, so a restart keeps the first of them.
        kept = min(ritz.shape[1], space - (want - n_done))
        basis, image = ritz[:, n_done:kept], ritz_image[:, n_done:kept]
        target, shift = ritz[:, n_done:want], theta[n_done:want]
        right = -residual[:, n_done:]
        own = lambda t: t - target * (target * t).sum(axis=0)  # noqa: E731  each column without its own Ritz vector
        project = lambda t: own(t - locked @ (locked.T @ t))
        fix = minres(product, shift, project(right), project, max(2.0 ** -(step + 1), 1e-3), inner)
        more = outside(fix, locked, basis)
        if not more.shape[1]:  # the corrections lie in the space already: try the residuals, else anything outside it
            more = outside(right, locked, basis)
        if not more.shape[1] and basis.shape[1] + locked.shape[1] < d:
            more = outside(np.random.default_rng(step + 1).standard_normal((d, WIDTH)), locked, basis)
        if more.shape[1]:
            basis, image = np.concatenate([basis, more], axis=1), np.concatenate([image, product(more)], axis=1)
        else:  # the space is everything: its images are taken anew, so that rounding doesn't stay
            basis = outside(basis, locked)
            image = product(basis)
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {k} eigenvectors after {outer} steps; residuals {norms}")
    order = np.argsort(values)[::-1]
    found = outside(locked[:, order], none)
    image = product(found)
    values = (found * image).sum(axis=0)
    return values, found, float(np.linalg.norm(image - found * values, axis=0).max())


def fit(rows: Rows, k: int = COMPONENTS) -> Fit:
    """Components with a variance that isn't just rounding, at most k."""
    if not rows.n:
        return Fit(0, [], np.empty(0), np.empty((0, 0)), 0.0, 0.0, 0.0)
    trace = rows.trace()
    if trace <= 0:
        return Fit(rows.n, rows.sums, np.empty(0), np.empty((rows.d, 0)), trace, 0.0, 0.0)
    values, vectors, residual = jacobi_davidson(rows.product, rows.d, k)
    real = values > EPS * rows.d * trace
    values, vectors = values[real], vectors[:, real]
    whole, rest, scale = rows.whole, rows.rest, np.sqrt(values)

    def f(x):
        z = (((x - whole) - rest) @ vectors) / scale
        return np.concatenate([z.T @ z, z.sum(axis=0)[:, None]], axis=1)

    sums = rows.summed(f, len(values) + 1) / rows.n
    mean = sums[:, -1]
    error = float(np.abs(sums[:, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return Fit(rows.n, rows.sums, values, vectors, trace, residual, error)


def whiten(vectors: DataFrame, key: str, k: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per vector (column x) and component."""
    table = written(vectors.select(quoted(key).alias("key"), "x"), "vectors")
    rows = Rows(table)
    own = fit(rows, k)
    n, d, m = own.n, rows.d, len(own.values)
    whole, rest, scale, turn = rows.whole, rows.rest, np.sqrt(own.values), own.vectors
    left = np.array([n * int(c) - s for c, s in zip(whole, own.sums, strict=True)], object)  # n * whole - sum
    explained = own.values / own.trace if m else own.values

    def run(batches):
        for batch in batches:
            if not m or not len(batch):
                continue
            y = matrix(batch.column(1), d) - whole
            z = ((y - rest) @ turn) / scale
            if float(n) * (float(np.abs(y).max()) + 1) < (1 << 62) ** 0.5 / max(1.0, d) ** 0.5:
                deviation = ((n * y + left.astype(np.int64)) ** 2).sum(axis=1)
            else:  # beyond 64 bits on the way
                deviation = [sum(v * v for v in (n * int(c) + e for c, e in zip(r, left, strict=True))) for r in y.tolist()]
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), m)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(batch))), pa.array(np.full(len(batch) * m, n)), pa.array(np.repeat(np.asarray(deviation, np.int64), m)),
                 pa.array(z.ravel()), pa.array(np.tile(explained, len(batch))), pa.array(np.full(len(batch) * m, own.error))],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = table.schema["key"].dataType.simpleString()
    out = table.mapInArrow(tidy(run), f"key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return out.select(F.col("key").alias(key), *(c for c in out.columns if c != "key"))
