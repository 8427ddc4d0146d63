"""Whitening of embeddings along their leading principal components.

Entries become whole numbers, floor(256 c). The different vectors of the table are the fit
list; its covariance V is never formed. Chebyshev-filtered subspace iteration finds the leading
eigenvectors: a block of vectors is multiplied by a polynomial of V that stays small on the
unwanted part of the spectrum and grows on the wanted one. Each step of the polynomial's
recurrence is one pass over the fit list, in which tasks centre their rows, multiply them with
the block and back, and Spark adds the partial products. Then the block is made orthonormal
(QR), a Rayleigh-Ritz step reads eigenvalues and vectors from it, and the residuals of the
wanted pairs decide whether another round is needed. Only (dimensions x block) numbers reach
the driver.

A row counts if its vector is as long as most are and all its entries are finite; other
rows are left out. Entries beyond 64 bits are clipped to them. Repeated vectors weigh once, and
their rows get equal results. Components of variance zero have null ``whitened``. An empty table gives an
empty result. Only ``vec_id`` and ``embedding`` are read. Where eigenvalues are equal, any
basis of their space is a right answer, one and the same for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import discard, materialize, store

SCALE = 256
#: Vectors iterated beside the wanted ones; they take in a cluster of eigenvalues and speed things up.
GUARDS = 20
DEGREE = 8
#: Steps that estimate the lower end of the spectrum.
LANCZOS = 8
MAX_ROUNDS = 200
#: Residuals, relative to the largest eigenvalue, that count as double precision.
CERTIFIED = 2e-15
_BATCH_ROWS = 8192


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that count; x are longs."""
    entries = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    known = rows.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    known = known.filter(F.size("embedding") > 0)
    # the usual length, the longest of several; there are few different ones
    sizes = known.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
    width = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return known.filter(F.size("embedding") == (width["size"] if width else 0)).select("vec_id", entries.alias("x"))


def _matrix(array: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0), np.int64)


def _summed(fit: DataFrame, partial: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over the fit list of matrices with ``width`` columns that ``partial`` makes of its batches."""
    kind = "i int, " + ", ".join(f"c{j} double" for j in range(width))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0))
            for begin in range(0, len(x), _BATCH_ROWS):
                part = partial(x[begin : begin + _BATCH_ROWS].astype(np.float64))
                total = part if total is None else total + part
        if total is not None:
            columns = {"i": pa.array(np.arange(len(total)), pa.int32())}
            yield pa.RecordBatch.from_pydict({**columns, **{f"c{j}": pa.array(total[:, j]) for j in range(width)}})

    sums = fit.select("x").mapInArrow(work, kind).groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)])
    return np.array([row[1:] for row in sorted(sums.collect())], np.float64)  # a row for each dimension


@dataclass(frozen=True)
class Fit:
    """The exact sums of the fit list, and what was found from it."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column for each
    trace: float
    identity_error: float | None
    residual: float  # largest of the wanted pairs, relative to the largest eigenvalue
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Decimal(s) / self.n) for s in self.sums])


def _exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension, in whole numbers of any size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            for begin in range(0, len(x), _BATCH_ROWS):
                # halves of 32 bits cannot overflow in a batch
                part = x[begin : begin + _BATCH_ROWS]
                high, low = (part >> 32).sum(axis=0), (part & 0xFFFFFFFF).sum(axis=0)
                whole = (high.astype(object) << 32) + low.astype(object)
                total = whole if total is None else total + whole
                count += len(part)
        if count:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(total)), pa.int32()),
                "n": pa.array([count] * len(total), pa.int64()),
                "s": pa.array([Decimal(v) for v in total.tolist()], pa.decimal128(38, 0)),
            })

    parts = fit.select("x").mapInArrow(work, "i int, n long, s decimal(38, 0)")
    sums = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    sums.sort(key=lambda row: row["i"])
    return (sums[0]["n"], [int(r["s"]) for r in sums]) if sums else (0, [])


def _times_covariance(mean: np.ndarray, n: int, block: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def partial(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ (centred @ block) / n

    return partial


def leading_components(fit: DataFrame, k: int, seed: int = 7) -> Fit:
    """The ``k`` leading eigenpairs of the covariance of ``fit`` (distinct ``x``, stored)."""
    n, sums = _exact_sums(fit)
    d = len(sums)
    nothing = Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, None, 0.0, 0)
    if not n:
        return nothing
    mean = np.array([float(Decimal(s) / n) for s in sums])
    passes = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _summed(fit, _times_covariance(mean, n, block), block.shape[1])

    k = min(k, d)
    size = min(d, k + GUARDS)
    variance = _summed(fit, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None] / n, 1)[:, 0]
    trace = float(variance.sum())
    # equal start vectors in a recomputed run; the first follow the dimensions that vary most
    start = np.random.default_rng(seed).standard_normal((d, size)) * np.sqrt(variance + trace / d * 1e-3)[:, None]
    if not trace:
        return Fit(n, sums, np.zeros(k), np.eye(d)[:, :k], 0.0, None, 0.0, 0)
    basis, _ = np.linalg.qr(start)
    floor, ceiling = _lowest(times, basis[:, :1]) if size < d else 0.0, 0.0
    best = np.inf
    for _ in range(MAX_ROUNDS):
        moved = times(basis)
        inner = basis.T @ moved
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-values)
        values, turn = values[order], turn[:, order]
        basis, moved = basis @ turn, moved @ turn
        residual = np.linalg.norm(moved[:, :k] - basis[:, :k] * values[:k], axis=0).max() / values[0]
        # rounding ends the fall of the residual a little above its own bound
        if residual <= CERTIFIED or (residual <= 1e-12 and residual > best / 2):
            break
        best, ceiling = min(best, residual), max(ceiling, values[-1])
        basis = _filtered(times, basis, moved, floor, ceiling, values[0])
    else:
        raise RuntimeError(f"the residual is still {residual} after {passes} passes")
    vectors, values = basis[:, :k], np.maximum(values[:k], 0.0)
    good = values > 1e-13 * trace
    error = None
    if good.any():
        weights = vectors[:, good] / np.sqrt(values[good])

        def products(x: np.ndarray) -> np.ndarray:
            z = (x - mean) @ weights
            return z.T @ z / n

        gap = _summed(fit, products, int(good.sum())) - np.eye(int(good.sum()))
        error = float(np.abs(gap).max())
    return Fit(n, sums, np.where(good, values, 0.0), vectors, trace, error, float(residual), passes)


def _lowest(times: Callable, start: np.ndarray) -> float:
    """About the smallest eigenvalue, rather less: the end of a few Lanczos steps minus their residual."""
    line, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(min(LANCZOS, len(start))):
        moved = times(line[-1])
        diagonal.append(float((line[-1] * moved).sum()))
        for old in line + line:  # twice, so that rounding leaves nothing along earlier ones
            moved = moved - old * float((old * moved).sum())
        beside.append(float(np.linalg.norm(moved)))
        if beside[-1] <= 1e-14 * abs(diagonal[0]):
            break
        line.append(moved / beside[-1])
    steps = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    values, vectors = np.linalg.eigh(steps)
    return max(0.0, float(values[0] - abs(beside[-1] * vectors[-1, 0])))


def _filtered(
    times: Callable, basis: np.ndarray, moved: np.ndarray, floor: float, ceiling: float, top: float
) -> np.ndarray:
    """The block times a Chebyshev polynomial of V that damps [floor, ceiling], orthonormal again.

    ``moved`` is V times the block, the first step. The recurrence is scaled by its value
    at ``top``, the largest Ritz value, so nothing overflows.
    """
    half, centre = (ceiling - floor) / 2, (ceiling + floor) / 2
    if half <= 1e-12 * top or top - centre <= half:  # nothing to damp: a power step
        return np.linalg.qr(moved)[0]
    sigma = first = half / (top - centre)
    before, now = basis, (moved - centre * basis) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        moved = times(now) - centre * now
        before, now = now, moved * (2 * following / half) - before * (sigma * following)
        sigma = following
    return np.linalg.qr(now)[0]


def _applied(fit: Fit) -> Column:
    """Struct of ``deviation`` (exact, a decimal) and the ``whitened`` entries of a row."""
    mean, n, sums = fit.mean, fit.n, fit.sums
    good = fit.values > 0
    weights = fit.vectors / np.where(good, np.sqrt(np.where(good, fit.values, 1.0)), np.nan)
    largest = max((abs(s) for s in sums), default=0)

    @F.arrow_udf("deviation decimal(38, 0), whitened array<double>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in batches:
            x = _matrix(array)
            z = ((x.astype(np.float64) - mean) @ weights) if len(x) else np.zeros((0, len(good)))
            bound = n * int(max(abs(int(x.max())), abs(int(x.min())))) + largest if x.size else 0
            if bound * bound * max(1, x.shape[1]) < 2**63:
                away = x * n - np.array(sums, np.int64) if x.size else x
                squares = (away * away).sum(axis=1)
            else:  # whole numbers of any size
                away = x.astype(object) * n - np.array(sums, object)
                squares = (away * away).sum(axis=1)
            flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
            offsets = pa.array(np.arange(len(x) + 1) * len(good), pa.int32())
            yield pa.StructArray.from_arrays(
                [
                    pa.array([Decimal(int(v)) for v in squares.tolist()], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["deviation", "whitened"],
            )

    return apply("x")


def whiten(rows: DataFrame, k: int = 4) -> tuple[DataFrame, Fit]:
    """``vec_id, deviation, whitened`` (an array of ``k`` entries) per usable row, and the fit.

    ``deviation`` is the exact sum over dimensions of (n x - S) squared, as decimal(38, 0).
    """
    found = usable(rows)
    path = store(found.select("x").distinct(), "fit-list")
    distinct = rows.sparkSession.read.parquet(path)
    fit = leading_components(distinct, k)
    discard(rows.sparkSession, path)
    return found.select("vec_id", _applied(fit).alias("w")).select("vec_id", "w.*"), fit


def whitening_report(rows: DataFrame, k: int = 4) -> DataFrame:
    """A row per usable row and component, with the fit's own measures.

    ``deviation`` is null where it does not fit a long; ``deviation_exact`` always holds it.
    """
    found, fit = whiten(rows, k)
    share = [float(e / fit.trace) if fit.trace else None for e in fit.values]
    shares = F.array(*[F.lit(s).cast("double") for s in share]) if share else F.array().cast("array<double>")
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(fit.identity_error).cast("double").alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )
