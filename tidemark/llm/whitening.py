"""Embedding whitening: leading components of the covariance by FEAST contour integration.

Spark makes the fit list (each distinct vector once), its sums and its covariance; that matrix, as wide as a vector, is
all that meets on the driver.  Inertia counts of the shifted covariance bracket the largest eigenvalues by
intervals with gaps around them.  For every interval a quadrature over a circle around it of solves with the shifted
covariance projects a random block onto the interval's eigenvectors; Rayleigh-Ritz extracts them, and their number
must equal the inertia count, so none can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import saved

#: Quadrature nodes on the upper half of a circle; columns of a block beyond those wanted; most projections of a block.
NODES, SPARE, MOST_ROUNDS = 12, 12, 40
#: Eigenvalues below this share of the trace count as zero: there is nothing to whiten along them.
ZERO = 1e-12
#: Eigenvalues nearer than this share of the largest lie in one interval, if there is no wider gap.
CLOSE = 1e-3
#: Most dimensions: the driver holds the covariance.
MOST_DIMENSIONS = 8192


# -- eigenpairs of a symmetric matrix ------------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of a tridiagonal matrix with v's eigenvalues, by Householder reflections."""
    a = v.astype(float).copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if not size:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k:]
        rest -= 2 * np.outer(x, x @ rest)
        below = a[k:, k + 1 :]
        below -= 2 * np.outer(below @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, below: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than shift: positive pivots of the shifted matrix (Sylvester's law)."""
    tiny = np.finfo(float).eps * max(1e-300, float(np.abs(diagonal).max(initial=0) + 2 * np.abs(below).max(initial=0)))
    pivot, count = 1.0, 0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (below[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def brackets(diagonal: np.ndarray, below: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, count) of intervals in falling order that hold the ``wanted`` largest eigenvalues, and some more where no gap follows them.

    Inertia counts halve each eigenvalue's interval until it is narrow; ends are put into the middle of gaps, the last
    one into the widest of those that follow.
    """
    n = len(diagonal)
    edge = np.abs(below)
    reach = np.concatenate([[0.0], edge]) + np.concatenate([edge, [0.0]])
    floor, top = float((diagonal - reach).min()), float((diagonal + reach).max())
    scale = max(abs(floor), abs(top)) or 1.0
    floor, top = floor - scale * CLOSE, top + scale * CLOSE
    known: dict[int, float] = {n + 1: floor - scale}

    def value(k: int) -> float:
        """The k-th largest eigenvalue, to CLOSE / 256 of the scale."""
        if k not in known:
            low, high = floor, top
            while high - low > scale * CLOSE / 256:
                middle = (low + high) / 2
                low, high = (middle, high) if inertia(diagonal, below, middle) >= k else (low, middle)
            known[k] = (low + high) / 2
        return known[k]

    gap = lambda k: value(k) - value(k + 1)
    out, first, high = [], 1, top
    while first <= min(wanted, n):
        last = first
        while last < min(wanted, n) and gap(last) <= scale * CLOSE:
            last += 1
        if last >= min(wanted, n):
            begin, width = last, SPARE
            last = max(range(begin, min(n, begin + width) + 1), key=gap)
            while gap(last) <= scale * CLOSE / 32:  # one cluster so far
                width *= 2
                last = max(range(begin, min(n, begin + width) + 1), key=gap)
        low = (value(last) + value(last + 1)) / 2 if last < n else floor
        out.append((low, high, inertia(diagonal, below, low) - inertia(diagonal, below, high)))
        first, high = last + 1, low
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in (low, high), falling, and unit eigenvectors as columns; count: how many there are by inertia.

    A Gauss-Legendre rule over the half circle gives the spectral projector of a block; the block is projected again
    until the residuals are those of double precision.
    """
    n = len(v)
    width = min(n, count + max(SPARE, count // 2))
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (x + 1) / 2)
    centre, radius = (low + high) / 2, (high - low) / 2
    size, best, worst = np.linalg.norm(v, 2) if n < 512 else np.linalg.norm(v), None, np.inf
    for _ in range(MOST_ROUNDS):
        total = np.zeros((n, width))
        for t, w in zip(turn, weight):
            total += (w / 2 * radius * t * np.linalg.solve((centre + radius * t) * np.eye(n) - v, block.astype(complex))).real
        basis = np.linalg.qr(total)[0]
        small, turned = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz, as wide as the block
        block = basis @ turned
        inside = np.flatnonzero((small > low) & (small < high))[::-1]
        if len(inside) != count:
            continue
        values, vectors = small[inside], block[:, inside]
        residual = float(np.linalg.norm(v @ vectors - vectors * values, axis=0).max(initial=0))
        if residual < worst:
            best, worst = (values, vectors), residual
        elif worst <= 1e-10 * size:  # no better any more
            break
        if worst <= 4e-16 * size:
            break
    if best is None or worst > 1e-10 * size:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but not as many were found")
    return best


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues that are not zero, falling, and unit eigenvectors as columns."""
    trace = float(np.trace(v))
    values, vectors = [], []
    if trace > 0:
        # an interval keeps away from what it must not hold; of a matrix of any scale
        scaled = v / trace
        narrow = tridiagonal(scaled)
        for low, high, count in brackets(*narrow, min(wanted, inertia(*narrow, ZERO))):
            e, u = feast(scaled, low, high, count)
            values.append(e * trace)
            vectors.append(u)
    if not values:
        return np.zeros(0), np.zeros((len(v), 0))
    e, u = np.concatenate(values), np.concatenate(vectors, axis=1)
    kept = np.flatnonzero(e > ZERO * trace)[:wanted]
    e, u = e[kept], u[:, kept]
    largest = np.abs(u).argmax(axis=0)
    return e, u * np.sign(u[largest, np.arange(len(kept))])


# -- the fit list and its moments ----------------------------------------------------------------------


def whole_numbers(vector: Column) -> Column:
    """x = floor(256 c) of every entry; null where the vector is null, holds null or what isn't a finite number that fits."""
    entries = F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double")))
    fit = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < 2.0**54, F.lit(False)))
    return F.when(fit, entries)


class Fit(NamedTuple):
    """n, the sums S, eigenvalues, eigenvectors as columns, the covariance's trace, and identity_error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float


def _grid(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(column))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _sums(x: np.ndarray) -> list[int]:
    """Column sums as whole numbers of any size."""
    if len(x) and int(np.abs(x).max(initial=0)) > (1 << 62) // len(x):
        return [sum(c) for c in x.T.tolist()]
    return x.sum(axis=0).tolist()


def _total(rows: DataFrame, task, d: int) -> np.ndarray:
    """The sum over all tasks of a d x d matrix that task(batches) gives, from its entries' sums in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                total += task(_grid(batch))
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total))], ["i", "row"])

    sums = rows.select("x").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((d, d))
    for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pylist():  # d x d rows
        out[r["i"], r["j"]] = r["v"]
    return out


def fit(vectors: DataFrame, components: int) -> Fit | None:
    """The fit of x-vectors (column x, arrays of one length); None if there are none.

    Every distinct vector counts once.  The covariance is summed over what is left of vectors without their
    mean; identity_error is taken from the whitened fit list itself, read once more.
    """
    rows = saved(vectors.distinct(), "fit")
    d = (rows.agg(F.max(F.size("x"))).first()[0]) or 0
    if not d:
        return None
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; the covariance of more than {MOST_DIMENSIONS} is not held on the driver")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _grid(batch)
                n, total = n + len(x), [a + b for a, b in zip(total, _sums(x))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([str(t) for t in [n, *total]])], ["i", "s"])

    sums = rows.mapInArrow(add, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = {r["i"]: int(r["s"]) for r in sums.collect()}  # a row for each dimension
    n, sums = sums[-1], [sums[i] for i in range(d)]
    mean = np.array([s / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        x = x - mean
        return x.T @ x

    v = _total(rows, products, d) / n
    v = (v + v.T) / 2
    values, u = leading(v, components)
    to = u / np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        w = np.concatenate([(x - mean) @ to, np.ones((len(x), 1))], axis=1)  # the ones give the sums
        out = np.zeros((d + 1, d + 1))
        out[: w.shape[1], : w.shape[1]] = w.T @ w
        return out

    k = len(values)
    error = 0.0
    if k:
        moments = _total(rows, whitened, d + 1) / n
        centre = moments[k, :k]
        error = float(np.abs(moments[:k, :k] - np.outer(centre, centre) - np.eye(k)).max())
    return Fit(n, sums, values, u, float(np.trace(v)), error)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1))
    own = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([o if o < 1 << 63 else None for o in own], pa.int64())


def whiten(rows: DataFrame, components: int = 4, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row with a vector and each component.

    Dropped are rows whose vector is null, empty, or holds null or an entry that is not finite or of 2^54 or more, and
    vectors that are not of the commonest length (of lengths as common the greatest): they are in no space with the
    others.  Components with an eigenvalue of zero are left out, so equal vectors alone give no rows.  deviation is
    null where it passes 64 bits.  Eigenvectors have their largest entry above zero.  Repeated rows and null ids stay;
    columns other than vec_id and the vector are not looked at; an empty table gives no rows.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col(vector)).alias("x")).where("x is not null and size(x) > 0")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return rows.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("x") == lengths["d"])
    made = fit(rows.select("x"), components)
    mean = np.array([s / made.n for s in made.sums])
    to = made.vectors / np.sqrt(made.values)
    k = len(made.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _grid(batch)
            take = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [batch.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, made.n))]
            columns += [_deviation(x, made.n, made.sums).take(take), pa.array(((x - mean) @ to).ravel()), pa.array(np.tile(made.values / made.trace, len(x))), pa.array(np.full(len(x) * k, made.error))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)
