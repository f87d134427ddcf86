"""Whitening of embeddings by shifted Cholesky QR: Gram passes over the centred rows, then an SVD of R."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import mapped, stored

PASSES = 6            # at most; three are enough but for extreme condition numbers
SETTLED = 1e-13       # the largest change of a Gram matrix from its own square, an orthonormal basis having none
NO_VARIANCE = 1e-13   # of the total: components below are rounding
UNIT = float(np.finfo(np.float64).eps) / 2


@dataclass(frozen=True)
class Whitening:
    """Fitted components: ``axes`` has one unit eigenvector per column, by falling ``variances``."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def scaled(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): the long floor(256 c) of every entry c of the vectors without null or non-finite entries.

    Entries are taken as double.  Null and empty vectors take no part, nor those
    that hold an entry beyond a long.  If vectors differ in length, those of the
    commonest length (of equals the longest) take part.
    """
    entries = F.transform(vector, lambda c: c.cast("double"))
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(F.forall(
        F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * 256) < F.lit(float(1 << 63)))), F.lit(False))
    fit = rows.filter(usable).select(F.col(key), F.transform(entries, lambda c: F.floor(c * 256).cast("bigint")).alias("x"))
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return fit.filter(F.size("x") == (lengths["d"] if lengths else 0))


def _rows(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, d)


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y with Y r = rows for an upper triangular ``r``, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _gram(fit: DataFrame, d: int, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of Y' Y over all rows, where ``made`` gives a block's Y: one matrix a task, summed up row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = made(_rows(batch, d))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total))], ["i", "row"])

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        rows = parts.column("row").combine_chunks()
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": [rows.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0)]})

    found = mapped(fit, run, "i int, row array<double>").groupBy("i").applyInArrow(add, "i int, row array<double>")
    return np.array([r["row"] for r in sorted(found.collect(), key=lambda r: r["i"])])


def _shifted_cholesky(gram: np.ndarray) -> np.ndarray:
    """The upper triangular R with R' R = gram + s I, for a shift s that makes it positive definite: a few roundings."""
    d = len(gram)
    shift = 11 * d * UNIT * max(float(np.linalg.norm(gram, 2)), 1e-300)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def fit(rows: DataFrame, most: int | None = None) -> Whitening | None:
    """Components of the distinct vectors of ``rows`` (key, x), at most ``most``; None if nothing varies.

    The centred rows A are never gathered.  A pass adds up the Gram matrix of
    the rows as orthogonalised so far, whose shifted Cholesky factor
    orthogonalises them once more by a triangular solve.  The product of the
    factors is R with A = Q R and orthonormal Q, so the singular values and right
    vectors of R are A's, without the squared condition number of a covariance.
    Directions without any variance come last and are left out.  Matrices have
    the vectors' dimension; only they reach the driver.
    """
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies")).select("x"))
    first = distinct.first()
    if first is None:
        return None
    d = len(first["x"])
    sums = [int(r["s"]) for r in distinct.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("j").collect()]
    n = distinct.count()
    mean = np.array([s / n for s in sums])
    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        y = x - mean
        for r in factors:
            y = solved(y, r)
        return y

    for turn in range(PASSES):
        gram = _gram(distinct, d, orthogonal)
        if not turn and not np.trace(gram):
            return None
        if turn and np.abs(gram @ gram - gram).max() < SETTLED * d:
            break
        factors.append(_shifted_cholesky(gram))
    product = np.eye(d)
    for r in factors:
        product = r @ product
    _, values, axes = np.linalg.svd(product)
    variances = values ** 2 / n
    shares = variances / variances.sum()
    k = min(d if most is None else most, int((shares > NO_VARIANCE).sum()))
    axes = axes[:k].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])  # the sign is free: the largest entry is positive
    scale = np.sqrt(variances[:k])

    def whitened(x: np.ndarray) -> np.ndarray:
        return np.hstack([(x - mean) @ axes / scale, np.ones((len(x), 1))])

    moments = _gram(distinct, d, whitened)
    means = moments[-1, :k] / n
    error = np.abs(moments[:k, :k] / n - np.outer(means, means) - np.eye(k)).max()
    return Whitening(n, tuple(sums), axes, variances[:k], shares[:k], float(error))


def _deviation(x: np.ndarray, n: int, sums: np.ndarray, exact: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S) ** 2 of every row, in whole numbers; None beyond a long."""
    most = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, exact), default=0)
    if len(exact) * most * most < 1 << 63:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    full = [sum((n * v - s) ** 2 for v, s in zip(row, exact)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in full]


def project(rows: DataFrame, model: Whitening | None, key: str) -> DataFrame:
    """One row for each vector of ``rows`` (key, x) and component.

    Returns ``key``, component (from 1), n, deviation, whitened, explained and
    identity_error.  Repeated rows and those with a null key give theirs too; a
    model of nothing gives no rows.
    """
    spark, kind = rows.sparkSession, dict(rows.dtypes)[key]
    schema = (f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    if model is None:
        return spark.createDataFrame([], schema)
    d, k = model.axes.shape
    mean, scale = model.mean, np.sqrt(model.variances)
    sums = np.array([s if abs(s) < 1 << 63 else 0 for s in model.sums], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, x = batch.num_rows, _rows(batch, d)
            far = np.repeat(np.array(_deviation(x, model.n, sums, model.sums), object), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, model.n)), pa.array(far.tolist(), pa.int64()),
                 pa.array(((x - mean) @ model.axes / scale).ravel()), pa.array(np.tile(model.explained, m)),
                 pa.array(np.full(m * k, model.identity_error))],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    named = rows.select(F.col(key).alias("key"), "x")
    return mapped(named, run, schema.replace(f"{key} ", "key ", 1)).withColumnRenamed("key", key)


def whiten(rows: DataFrame, most: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The whitened coordinates of every vector (see ``scaled``, ``fit`` and ``project``); other columns play no part."""
    x = stored(scaled(rows, key, vector))
    return project(x, fit(x, most), key)
