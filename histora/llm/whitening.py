"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 12).

The fit list X holds each distinct scaled vector once, as a row; its columns are centred before anything is multiplied. The method
builds X V = U B with orthonormal V (right) and U (left) and a small upper bidiagonal B. The SVD of B gives the components, V times its
right singular vectors, and their deviations.

The vectors of U are as long as the fit list, so they are never stored: u_j = X w_j for a short w_j that follows the same recurrence as
u_j. One pass over the rows computes u = X w in each task and adds up X'u at once; a lost task reads its rows again. With the
stored z_j = X'u_j = X'X w_j, the products u_i . (X w) that the reorthogonalisation of U needs are z_i . w. Both sides are
reorthogonalised fully, twice each step.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.llm.common import saved, ship

#: Relative size below which a recurrence has come to its end
TINY = 1e-12
#: Relative residual at which components count as found
TOLERANCE = 1e-15


class Whitening(NamedTuple):
    """n vectors of the fit list, exact sums S of its dimensions, components as rows, their variances, the trace of the covariance, and
    the largest deviation of the whitened fit list's covariance from the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def _orthogonal(v: np.ndarray, basis: list[np.ndarray], duals: list[np.ndarray]) -> np.ndarray:
    """v less its parts along the basis, measured by the duals; done twice, as once leaves rounding errors."""
    if basis:
        q, p = np.array(basis), np.array(duals)
        for _ in range(2):
            v = v - q.T @ (p @ v)
    return v


def golub_kahan(products: Callable, size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors (as rows) and singular values of a matrix with `size` columns.

    products(w) gives |Xw| squared and X'Xw. Directions in which the matrix is null have no vector. Ends when the wanted ones have
    converged, if less than half of the steps that span all columns are done by then; a second run beside the vectors found
    looks for equal singular values that a single start cannot see.
    """
    found, values = np.zeros((0, size)), np.zeros(0)
    rng = np.random.default_rng(seed)
    while True:
        more, high, spanned = _run(products, size, wanted, found, rng)
        before = len(found)
        found, values = np.concatenate([found, more]), np.concatenate([values, high])
        order = np.argsort(-values, kind="stable")
        found, values = found[order], values[order]
        news = len(high) and (before < wanted or high[0] > values[wanted - 1] * (1 - 1e-9))
        if spanned or not news or (before and not len(high)):
            return found[:wanted], values[:wanted]


def _run(products: Callable, size: int, wanted: int, beside: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, bool]:
    away = list(beside)
    v = [_unit(_orthogonal(rng.standard_normal(size), away, away))]
    w, z, alpha, beta = [], [], [], []
    norm, broken, room = 0.0, False, size - len(away)
    while True:
        step = v[-1] - beta[-1] * w[-1] if w and beta[-1] else v[-1]
        step = _orthogonal(step, w, z)
        square, image = products(step)
        a = float(np.sqrt(max(square, 0.0)))
        norm = max(norm, a)
        if a <= TINY * norm or not a:
            # X maps what is left of this direction to nothing: a zero row of B, no left vector
            a, image = 0.0, np.zeros(size)
            w.append(np.zeros(size))
        else:
            w.append(step / a)
            image = image / a
        z.append(image)
        alpha.append(a)
        if len(v) == room:
            break
        following = _orthogonal(image - a * v[-1], v + away, v + away)
        b = float(np.linalg.norm(following))
        norm = max(norm, b)
        if b <= TINY * norm or not b:
            # the vectors so far span an invariant space: go on in another direction
            b, broken = 0.0, True
            following = _orthogonal(rng.standard_normal(size), v + away, v + away)
        beta.append(b)
        if not broken and len(v) >= wanted and 2 * len(v) < room:
            left, s, _ = np.linalg.svd(_bidiagonal(alpha, beta[:-1]))
            if (b * np.abs(left[-1, :wanted]) <= TOLERANCE * s[0]).all():
                break
        v.append(_unit(following))
    _, s, right = np.linalg.svd(_bidiagonal(alpha, beta[: len(alpha) - 1]))
    keep = s > TINY * max(s[0], norm)
    keep[wanted:] = False
    return (right @ np.array(v))[keep], s[keep], len(v) == room


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v)
    return v / size if size else v


def _bidiagonal(diagonal: list[float], upper: list[float]) -> np.ndarray:
    return np.diag(diagonal) + np.diag(upper, 1) if upper else np.array([diagonal])


def _matrix(batch, column: int, size: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(fit: DataFrame, values: Callable[[np.ndarray], np.ndarray], count: int, size: int) -> np.ndarray:
    """The sum of values(rows), `count` numbers, over all batches of rows: added up in each task, then by Spark."""

    def run(batches):
        total = np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                total += values(_matrix(batch, 0, size).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(total)], names=["i", "value"])

    rows = fit.select("x").mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(count)
    for r in rows:
        total[r.i] = r.value
    return total


def _exact_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension."""

    def run(batches):
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _matrix(batch, 0, size)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        total = [Decimal(n), *(Decimal((h << 32) + k) for h, k in zip(high.tolist(), low.tolist(), strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["i", "value"])

    rows = fit.select("x").mapInArrow(run, "i int, value decimal(38,0)").groupBy("i").agg(F.sum("value").alias("value")).collect()
    found = {r.i: int(r.value) for r in rows}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(size)]


def scaled(vector: Column) -> Column:
    """floor(256 * c) of every entry as long; null for a null or empty vector and one with null or non-finite entries."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & finite, F.transform(vector, lambda c: F.floor(c.cast("double") * 256).cast("long")))


def _usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, x) of the rows with vectors of the dimension that most of them have (the larger one, if as many), and that dimension."""
    rows = df.select(F.col(id_col).alias("id"), scaled(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    size = sizes.d if sizes else 0
    return rows.where(F.size("x") == size), size


def fit_whitening(rows: DataFrame, size: int, components: int = 4) -> Whitening:
    """Fit to the distinct vectors of `rows` (id, x) by passes over them."""
    fit = saved(rows.select("x").distinct(), "whitening-fit")
    n, sums = _exact_sums(fit, size)
    mean = np.array([s / n for s in sums]) if n else np.zeros(size)
    shared = fit.sparkSession.sparkContext.broadcast(mean)
    trace = float(_summed(fit, lambda x: np.array([((x - shared.value) ** 2).sum()]), 1, size)[0])

    def products(w: np.ndarray) -> tuple[float, np.ndarray]:
        def both(x):
            x = x - shared.value
            u = x @ w
            return np.concatenate([[u @ u], u @ x])

        total = _summed(fit, both, size + 1, size)
        return float(total[0]), total[1:]

    vectors, deviations = golub_kahan(products, size, min(components, size)) if trace else (np.zeros((0, size)), np.zeros(0))
    k, scale = len(vectors), vectors / (deviations[:, None] / np.sqrt(n)) if len(vectors) else vectors

    def moments(x):
        y = (x - shared.value) @ scale.T
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    total = _summed(fit, moments, k + k * k, size) / max(n, 1) if k else np.zeros(0)
    error = np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max() if k else 0.0
    return Whitening(n, sums, vectors, deviations**2 / max(n, 1), trace / max(n, 1), float(error))


def deviations_squared(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * x - S) ** 2 over the dimensions of each row, exact; None beyond 38 digits.

    Arithmetic modulo 2 ** 64 is exact wherever the result fits in 63 bits; an estimate in floating point tells where it may not.
    """
    signed = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in sums], np.int64)
    rest = x * np.int64((n + (1 << 63)) % (1 << 64) - (1 << 63)) - signed
    exact = (rest * rest).sum(axis=1).tolist()
    about = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(axis=1)
    for i in np.flatnonzero(about > 9.0e18).tolist():
        value = sum((n * a - s) ** 2 for a, s in zip(x[i].tolist(), sums, strict=True))
        exact[i] = value if value < 10**38 else None
    return exact


def whitened_components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """Whitened coordinates of every vector: a row for each vector and component (numbered from 1 by falling variance).

    Returns id_col, component, n, deviation (decimal, exact), whitened, explained and identity_error. Null and empty vectors and those with
    null or non-finite entries are left out, as are vectors of another dimension than most have. Components without variance do
    not exist: equal vectors, a single one or an empty table give no rows. Equal components (ties) may be any orthonormal ones of
    their space. Repeated rows and null ids come back as they are, and count once in the fit; other columns are not read.
    deviation is null beyond 38 digits.
    """
    ship(df.sparkSession)
    rows, size = _usable(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not size:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    model = fit_whitening(rows, size, components)
    shared, k = df.sparkSession.sparkContext.broadcast(model), len(model.variances)

    def run(batches):
        m = shared.value
        mean, scale = np.array([s / m.n for s in m.sums]), m.components / np.sqrt(m.variances)[:, None]
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch, 1, size)
            deviation = [None if d is None else Decimal(d) for d in deviations_squared(x, m.n, m.sums)]
            at = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, m.n)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(at),
                    pa.array(((x - mean) @ scale.T).ravel()),
                    pa.array(np.tile(m.variances / m.trace, len(x))),
                    pa.array(np.full(len(x) * k, m.identity_error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
