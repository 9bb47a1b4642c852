"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X has the centred vectors as rows; it stays a written table. Step j multiplies X with a right vector v_j, takes off what
belongs to the left vector before, u_{j-1}, and multiplies the outcome's transpose with X again, all in one pass over the rows.
The coefficients are a bidiagonal matrix B with X V = U B; the singular values and right vectors of B, a matrix as large as the number
of steps, are those of X. Right vectors, one number for each dimension, are kept and reorthogonalised on the driver. Left
vectors, one number for each row, never leave the tasks: each is X g for a small vector g, so their products with
each other are products of small vectors too, and they are reorthogonalised without another pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import materialize, read_table

SCALE, OFFSET = 64, 1_000_000
#: 64 * c of a greater size does not fit a long.
MOST = float(1 << 55)
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Whitening:
    """What a table of vectors is whitened with. Component k is components[:, k], of the variance eigenvalues[k]."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, x array<bigint>: floor(64 * c) + 1000000 of each entry c, one row for each row with a usable vector.

    Vectors that are null or hold nulls, NaN, infinities or entries of 2^55 and more are left out, and so
    are vectors of another length than most have (of equally frequent lengths the greater counts). Repeated
    rows stay repeated, null ids are ids, and extra columns are not read.
    """
    c = F.col(vec_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).alias("vec_id"), c.alias("c")).filter(F.col("c").isNotNull() & F.forall("c", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < MOST), F.lit(False))))
    numbers = usable.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE) + OFFSET).alias("x"))
    lengths = numbers.groupBy(F.size("x").alias("dims")).count()
    dims = lengths.agg(F.max_by("dims", F.struct("count", "dims"))).first()[0]
    return numbers.filter(F.size("x") == (dims or 0))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def exact_sums(numbers: DataFrame) -> tuple[int, list[int]]:
    """The number of rows, and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, []
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch)
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                part = [(h << 32) + s for h, s in zip(high, low, strict=True)]
                total = [a + b for a, b in zip(total, part, strict=True)] if total else part
                n += len(x)
        sums = pa.array([n, *total]) if all(abs(s) < 1 << 62 for s in total) else pa.array([n, *total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), sums.cast(pa.decimal128(38, 0))], ["k", "s"])

    found = numbers.mapInArrow(run, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()
    by_dim = {r["k"]: int(r["s"]) for r in found}
    n = by_dim.pop(-1, 0)
    return n, [by_dim[k] for k in sorted(by_dim)]


def _totals(numbers: DataFrame, n: int, sums: list[int], work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of work(centred rows) over all blocks of rows. Each task adds its own blocks up."""
    whole, rest = _centre(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work((_rows(batch) - whole) - rest)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["k", "s"])

    out = np.zeros(size)
    for r in numbers.mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect():
        out[r["k"]] = r["s"]
    return out


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Means as whole numbers and rests below 1, so that a difference to them loses nothing of large entries."""
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def bidiagonal(product: Callable[[np.ndarray], tuple[np.ndarray, float]], dims: int, wanted: int, tolerance: float = 0.0, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors as columns, B). product(h) gives X'(X h) and |X h|^2.

    All `dims` steps are taken, or with a tolerance only so many that the `wanted` greatest singular values' vectors
    leave a residual below it, as a share of the greatest. Where the vectors reached so far are a closed space, a new one orthogonal to all starts.
    """
    rng = np.random.default_rng(seed)
    right, g, z = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    alphas, betas, beta, scale = [], [], 0.0, 0.0

    def orthogonal(r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - right @ (right.T @ r)
        return r

    v = rng.standard_normal(dims)
    v /= np.linalg.norm(v)
    for j in range(dims):
        right = np.column_stack([right, v])
        h = v - beta * g[:, -1] if j and beta else v
        q, square = product(h)
        scale = max(scale, np.sqrt(square), beta)
        for again in range(2):
            c = g.T @ q  # products with the left vectors so far
            h, q, square = h - g @ c, q - z @ c, max(square - c @ c, 0.0)
            if c @ c <= 1e-12 * square or again or square <= (dims * EPS * scale) ** 2:
                break
            q, square = product(h)  # much was taken off: multiply what is left anew
        alpha = np.sqrt(square)
        if alpha <= dims * EPS * scale:
            alpha, own_g, own_z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            own_g, own_z = h / alpha, q / alpha
        g, z = np.column_stack([g, own_g]), np.column_stack([z, own_z])
        alphas.append(alpha)
        if j + 1 == dims:
            break
        r = orthogonal(own_z)
        beta = float(np.linalg.norm(r))
        if beta <= dims * EPS * scale:
            beta, r = 0.0, orthogonal(rng.standard_normal(dims))
        elif tolerance and j + 1 >= wanted:
            left, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if (beta * np.abs(left[-1, :wanted]) <= tolerance * values[0]).all():
                break
        v = orthogonal(r / np.linalg.norm(r))
        v /= np.linalg.norm(v)
        betas.append(beta)
    return right, np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


def fit_whitening(numbers: DataFrame, most: int = 32, tolerance: float = 0.0) -> Whitening | None:
    """The whitening of a written table of whole_numbers(); None if it is empty.

    Components are the eigenvectors of the covariance by falling eigenvalue, `most` at most; directions in which nothing
    varies are no components. A pass a dimension is made over the table (fewer with a tolerance), and a last one that checks the outcome.
    """
    n, sums = exact_sums(numbers)
    if not n:
        return None
    dims = len(sums)

    def product(h: np.ndarray) -> tuple[np.ndarray, float]:
        def work(y: np.ndarray) -> np.ndarray:
            p = y @ h
            return np.r_[y.T @ p, p @ p]

        found = _totals(numbers, n, sums, work, dims + 1)
        return found[:-1], float(found[-1])

    right, b = bidiagonal(product, dims, most, tolerance) if dims else (np.zeros((0, 0)), np.zeros((0, 0)))
    _, values, turned = np.linalg.svd(b)
    real = np.flatnonzero(values > dims * EPS * max(values, default=0.0))[:most]
    components = right @ turned.T[:, real]
    eigenvalues = values[real] ** 2 / n
    k = len(real)
    towards = components / np.sqrt(eigenvalues)

    def check(y: np.ndarray) -> np.ndarray:
        w = y @ towards
        return np.r_[(w.T @ w).ravel(), w.sum(axis=0), (y * y).sum()]

    found = _totals(numbers, n, sums, check, k * k + k + 1) / n
    mean = found[k * k : -1]
    covariance = found[: k * k].reshape(k, k) - np.outer(mean, mean)  # the rows are centred already; their rounding is taken off
    return Whitening(n, sums, components, eigenvalues, float(found[-1]), float(np.abs(covariance - np.eye(k)).max(initial=0.0)))


def whiten(numbers: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation decimal(38,0), whitened array<double>: one row for each row of numbers.

    deviation is the sum over dimensions of (n * x - S)^2, exact; null from 10^38 on.
    """
    whole, rest = _centre(model.n, model.sums)
    n, remainders = model.n, np.array([s % model.n for s in model.sums], object)
    towards = model.components / np.sqrt(model.eigenvalues)
    kind = pa.decimal128(38, 0)

    def squares(x: np.ndarray) -> pa.Array:
        apart = x - whole
        if n * (float(np.abs(apart).max(initial=0)) + 1) * np.sqrt(max(1, x.shape[1])) < 3e9:
            small = n * apart - remainders.astype(np.int64)
            return pa.array((small * small).sum(axis=1)).cast(kind)
        found = ((n * apart.astype(object) - remainders) ** 2).sum(axis=1)
        return pa.array([s if s < 10**38 else None for s in found], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch)
                w = ((x - whole) - rest) @ towards
                ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), squares(x), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["vec_id", "deviation", "whitened"])

    return numbers.mapInArrow(run, f"vec_id {numbers.schema['vec_id'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector and component. A deviation that no long holds is null here; whiten() has it."""
    numbers = materialize(whole_numbers(read_table(spark, sf_dir, "embeddings")), "vectors")
    return components_of(numbers, fit_whitening(numbers))


def components_of(numbers: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation long, whitened, explained, identity_error: whiten() a row for each component."""
    if model is None:
        kind = numbers.schema["vec_id"].dataType.simpleString()
        return numbers.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    each = whiten(numbers, model).select("vec_id", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
