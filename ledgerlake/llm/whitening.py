"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never gathered and no covariance matrix is formed.  Each
step is one pass over the stored rows: every task forms its part of u = X v and
adds up its part of Xᵀu.  Left vectors are orthogonalised against all earlier
left vectors and right vectors against all earlier right vectors.  The small
upper bidiagonal matrix B of the steps has X's singular values; its right
singular vectors, taken through the Lanczos vectors, are the components.

A left vector has one entry for each row, so it is not kept: all of them lie in
the range of X, u = X z, and the driver keeps the short z.  A pass rebuilds all
left vectors of its rows with one small matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import materialize, quoted

SCALE, SHIFT = 1024, 100_000
#: Singular values below this share of the largest one count as zero.
RANK = 1e-10


def offsets(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, y) of every vector that is not null and holds finite entries only; y is floor(1024 * c)
    of each entry, the contract's x less its constant 100000."""
    v = quoted(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(v.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(quoted(id_col).alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("y")))


def matrix(column: pa.ListArray, terms: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, terms)


@dataclass
class Whitening:
    """What a fit learns: row count, exact sums of y, components (as columns) and their eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    steps: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues


def added(rows: DataFrame, of, size: int) -> np.ndarray:
    """Sum over all rows of the vector ``of(y matrix)``; each task sends one partial sum to the next level."""

    def part(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "x"])

    found = rows.mapInArrow(part, "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()  # size numbers
    out = np.zeros(size)
    for r in found:
        out[r.k] = r.x
    return out


def bidiagonalise(rows: DataFrame, mean: np.ndarray, norm: float, seed: int, tolerance: float, wanted: int):
    """(V, B): right Lanczos vectors as columns and the upper bidiagonal matrix of the steps taken.

    Ends when V spans all dimensions, or when the residuals of the ``wanted`` largest singular
    vectors are below ``tolerance`` of the largest singular value and what X holds outside V is
    less than the smallest of them (equal singular values show up one after the other).
    A step that finds an invariant subspace goes on from a fresh direction.
    """
    terms = len(mean)
    rng = np.random.default_rng(seed)
    V, Z, W = (np.zeros((terms, 0)) for _ in range(3))  # right vectors; left vectors are X Z; W = Xᵀ X Z
    alpha, beta = [], []

    def fresh() -> np.ndarray | None:
        v = orthogonal(rng.standard_normal(terms), V)
        return v / np.linalg.norm(v) if V.shape[1] < terms else None

    v = fresh()
    while v is not None:
        back = beta[-1] if beta else 0.0
        z = v - back * Z[:, -1] if back else v.copy()
        basis, k = np.column_stack([z, Z]), Z.shape[1]

        def products(column):
            x = matrix(column, terms) - mean
            left = x @ basis  # this step's u and all earlier left vectors of these rows
            u = left[:, 0]
            return np.concatenate([x.T @ u, left.T @ u])

        got = added(rows, products, terms + 1 + k)
        toward, square, overlap = got[:terms], got[terms], got[terms + 1 :]
        z, toward = z - Z @ overlap, toward - W @ overlap  # full reorthogonalisation of u
        a = float(np.sqrt(max(square - overlap @ overlap, 0.0)))
        V = np.column_stack([V, v])
        if a > RANK * norm:
            Z, W = np.column_stack([Z, z / a]), np.column_stack([W, toward / a])
            alpha.append(a)
            step = orthogonal(toward / a - a * v, V)
            b = float(np.linalg.norm(step))
        else:  # v is in the null space of X: a zero column, and no way on from it
            Z, W = np.column_stack([Z, np.zeros(terms)]), np.column_stack([W, np.zeros(terms)])
            alpha.append(0.0)
            b = 0.0
        live = b > RANK * norm
        beta.append(b if live else 0.0)
        if live:
            left, s, _ = np.linalg.svd(bidiagonal(alpha, beta[:-1]))
            outside = norm**2 - (s**2).sum()
            if len(s) > wanted and (b * np.abs(left[-1, :wanted])).max() <= tolerance * s[0] and outside < s[wanted - 1] ** 2:
                break
        v = (step / b if V.shape[1] < terms else None) if live else fresh()
    return V, bidiagonal(alpha, beta[: len(alpha) - 1])


def orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` without its part in the orthonormal columns of ``basis`` (twice is enough)."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonal(alpha: list[float], beta: list[float]) -> np.ndarray:
    return np.diag(alpha) + np.diag(beta, 1) if len(alpha) > 1 else np.array([alpha])


def fit(rows: DataFrame, most: int = 8, seed: int = 7, tolerance: float = 1e-13) -> Whitening:
    """Components of all ``rows`` (id, y); see ``whiten``."""
    size = F.size("y")
    n, least, terms = rows.agg(F.count("*"), F.min(size), F.max(size)).first()
    if not n or not terms:
        return Whitening(n or 0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    if least != terms:
        raise ValueError(f"vectors of {least} to {terms} entries cannot be whitened together")
    high = rows.agg(F.max(F.array_max(F.transform("y", F.abs)))).first()[0]
    if high * n >= 2**53:
        raise OverflowError("sums over the entries times 1024 would not be exact in doubles")
    y = rows.select("y")
    sums = added(y, lambda c: matrix(c, terms).sum(axis=0), terms)  # whole numbers below 2**53: exact
    mean = sums / n
    trace = float(added(y, lambda c: [((matrix(c, terms) - mean) ** 2).sum()], 1)[0])
    norm = float(np.sqrt(trace))
    if not norm:
        return Whitening(n, [int(s) for s in sums], np.zeros((terms, 0)), np.zeros(0), 0.0, 0)
    V, B = bidiagonalise(y, mean, norm, seed, tolerance, most)
    _, s, right = np.linalg.svd(B)
    kept = s[:most] > RANK * s[0]
    return Whitening(n, [int(x) for x in sums], (V @ right.T)[:, : len(s)][:, :most][:, kept], (s[:most] ** 2 / n)[kept], trace / n, len(s))


def whiten(df: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Entries c become x = floor(1024 * c) + 100000; ``deviation`` is the exact sum over
    dimensions of (n*x - S)^2 as decimal(38,0), ``whitened`` the centred vector's
    projection on the component over the square root of its eigenvalue.
    ``identity_error`` is the largest absolute entry of the covariance of the whitened
    rows minus the identity, measured over all of them.

    Rows whose vector is null or holds a null or non-finite entry are dropped; all
    others are fitted, repeated ones too.  A null id stays null; other columns are not
    read.  Components of zero variance are left out (division by zero), so equal vectors,
    a single one, vectors without entries and an empty table give no rows.  Vectors of
    different lengths raise, and so do entries too large for exact sums.

    The rows are written once; each Lanczos step reads them in one pass and brings
    a few hundred sums to the driver.
    """
    rows = materialize(offsets(df, id_col, vector_col), "whitening-rows")
    fitted = fit(rows, most, **options)
    kind, count, n = rows.schema["id"].dataType, len(fitted.eigenvalues), fitted.n
    schema = StructType([StructField("id", kind), StructField("squares", LongType()), StructField("mixed", LongType()),
                         *(StructField(f"w{k}", DoubleType()) for k in range(count))])
    sums, terms = np.array(fitted.sums, np.float64), len(fitted.sums)
    ahead = fitted.components / np.sqrt(fitted.eigenvalues) if count else fitted.components

    def project(batches):
        for batch in batches:
            if batch.num_rows and count:
                y = matrix(batch.column(1), terms)
                exact, whole = y.astype(np.int64), sums.astype(np.int64)
                w = (y - sums / n) @ ahead
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((exact * exact).sum(axis=1)), pa.array(exact @ whole),
                                                  *(pa.array(np.ascontiguousarray(w[:, k])) for k in range(count))],
                                                 names=[f.name for f in schema.fields])

    done = materialize(rows.mapInArrow(project, schema), "whitened")
    error = identity_error(done, count, n)
    total, square = F.lit(n).cast("decimal(20,0)"), sum(s * s for s in fitted.sums)
    # sum of (n*y - T)^2 by expanding: n*n*squares - 2*n*mixed + sum of T^2, in whole numbers
    deviation = (total * (total * F.col("squares").cast("decimal(20,0)") - 2 * F.col("mixed").cast("decimal(20,0)"))
                 + F.lit(str(square)).cast("decimal(38,0)")).cast("decimal(38,0)")
    explained = fitted.explained
    each = [F.struct(F.lit(k + 1).alias("component"), F.col(f"w{k}").alias("whitened"), F.lit(float(explained[k])).alias("explained"))
            for k in range(count)]
    if not each:
        each = [F.struct(F.lit(0).alias("component"), F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"))]
    return (done.withColumn("deviation", deviation).select("id", "deviation", F.explode(F.array(*each)).alias("c"))
            .select(F.col("id").alias(id_col), "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
                    F.lit(error).alias("identity_error")))


def identity_error(done: DataFrame, count: int, n: int) -> float:
    """Largest absolute entry of cov(w) - I over all whitened rows, centred before multiplying."""
    if not count or not n:
        return 0.0
    names = [f"w{k}" for k in range(count)]
    means = done.agg(*(F.avg(c).alias(c) for c in names)).first()
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    found = done.agg(*(F.sum((F.col(names[a]) - means[a]) * (F.col(names[b]) - means[b])) / n for a, b in pairs)).first()
    return float(max(abs(x - (a == b)) for x, (a, b) in zip(found, pairs)))
