"""Whitening of embeddings by exact principal components.

Entries become integers, so the scatter matrix n * sum(x x') - S S' is exact.
Its characteristic polynomial (modular Hessenberg reductions, one prime each,
put together by Chinese remaindering) gives the eigenvalues to any precision,
and inverse iteration near them the components; see ``charpoly``.

Rows are only ever read in parallel: exact moments are summed per task and
then by Spark; primes and roots are rows of their own; what reaches the driver
is bounded by the square of the vectors' length.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import charpoly
from tabforge.llm.common import prepare

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LONG = 1 << 63
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_exact decimal(38,0)")


# ------------------------------------------------------------------ numbers
def entries(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) of each entry; shorter vectors end in entries of 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() >= 2.0**62:
        raise ValueError("a vector entry is too large for integer moments")
    flat = flat.astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths),
        np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def gram(y: np.ndarray) -> np.ndarray:
    """y'y exactly, as Python integers where 64 bits may not do."""
    most = int(np.abs(y).max(initial=0)) ** 2 * max(1, len(y))
    if most < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if most < LONG:
        return (y.T @ y).astype(object)
    o = y.astype(object)
    return o.T @ o


def distances(y: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """n * y - sums per row, and each row's sum of squares, both exact."""
    most = n * int(np.abs(y).max(initial=0)) + max([abs(s) for s in sums] + [0])
    if most * most * max(1, len(sums)) < LONG:
        d = n * y - np.array(sums, np.int64)[None, :]
        return d, (d * d).sum(axis=1).tolist()
    d = n * y.astype(object) - np.array(sums, object)[None, :]
    return d, [sum(v * v for v in row) for row in d]


# -------------------------------------------------------------------- Spark
def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows whose vector has no NULL or non-finite entry."""
    bad = F.exists(rows["embedding"], lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(rows["embedding"].isNotNull() & ~bad).select(
        rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].cast("array<double>").alias("embedding"))


def moments(vectors: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and sums of products of the entries, exact.

    Each task adds up its own rows; Spark adds the tasks' numbers by place.
    """
    def run(batches):
        n, s, g = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for b in batches:
            y = entries(b.column("embedding"), dims)
            n, s, g = n + len(y), s + y.astype(object).sum(axis=0), g + gram(y)
        if n:
            i, j = np.triu_indices(dims)
            at = np.r_[-1, np.arange(dims), i], np.r_[-1, np.full(dims, -1), j]
            values = [Decimal(int(v)) for v in [n, *s, *g[i, j]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(values, pa.decimal128(38, 0))],
                names=["i", "j", "v"])

    rows = (vectors.select("embedding").mapInArrow(run, "i int, j int, v decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())  # (dims + 1) (dims + 2) / 2 numbers
    n, sums, g = 0, [0] * dims, np.zeros((dims, dims), object)
    for r in rows:
        if r["i"] < 0:
            n = int(r["v"])
        elif r["j"] < 0:
            sums[r["i"]] = int(r["v"])
        else:
            g[r["i"], r["j"]] = g[r["j"], r["i"]] = int(r["v"])
    return n, sums, g


def scatter(n: int, sums: list[int], g: np.ndarray) -> list[list[int]]:
    """n^2 times the covariance, in integers."""
    s = np.array(sums, object)
    return [[int(v) for v in row] for row in n * g - np.multiply.outer(s, s)]


def polynomial(spark: SparkSession, matrix: list[list[int]], per_task: int = 16) -> list[int]:
    """Characteristic polynomial; the primes are rows dealt over the executors."""
    trace, d = sum(matrix[i][i] for i in range(len(matrix))), len(matrix)
    primes = charpoly.primes_for(trace, d)

    def run(batches):
        for b in batches:
            p = b.column("prime").to_pylist()
            for at in range(0, len(p), per_task):
                part = p[at:at + per_task]
                got = charpoly.residues(matrix, part)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(list(got), pa.list_(pa.int64()))],
                                                 names=["prime", "c"])

    tasks = max(1, min(math.ceil(len(primes) / per_task), 4 * spark.sparkContext.defaultParallelism))
    rows = (spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
            .mapInArrow(run, "prime long, c array<long>").collect())  # about dims^2 numbers times their size
    return charpoly.remainder({r["prime"]: r["c"] for r in rows}, trace)


def components(spark: SparkSession, matrix: list[list[int]], k: int = COMPONENTS) -> tuple[list[Fraction], np.ndarray]:
    """The ``k`` largest eigenvalues of a scatter matrix and its unit eigenvectors (rows).

    Eigenvalues fall; each root's null space is one row, solved on an executor. Roots that are
    equal share a null space, of which an orthonormal basis is taken. Vectors
    of the eigenvalue 0 are not computed (rows of zeros).
    """
    d = len(matrix)
    poly = polynomial(spark, matrix)
    near = np.linalg.eigvalsh(np.array(matrix, np.float64)) if d else np.zeros(0)
    top = near[::-1][:k + 1]
    roots = charpoly.largest_roots(poly, k, [(a + b) / 2 for a, b in zip(top, top[1:])])
    values = [v for v, first, size in roots for _ in range(min(size, k - first))]
    out = np.zeros((len(values), d))
    tasks = [(first, min(size, k - first), str(v.numerator), str(v.denominator)) for v, first, size in roots if v > 0]

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                vs = charpoly.null_space(matrix, Fraction(int(r["num"]), int(r["den"])), r["size"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(r["first"], r["first"] + r["size"]), pa.int32()), pa.array(list(vs), pa.list_(pa.float64()))],
                    names=["component", "v"])

    if tasks:
        found = (spark.createDataFrame(tasks, "first int, size int, num string, den string").repartition(len(tasks))
                 .mapInArrow(run, "component int, v array<double>").collect())  # at most k vectors
        for r in found:
            out[r["component"]] = r["v"]
    return values, out


class Model:
    """Everything a task needs to whiten a row."""

    def __init__(self, n: int, sums: list[int], values: list[Fraction], vectors: np.ndarray, trace: int):
        self.n, self.sums, self.vectors = n, sums, vectors
        # eigenvalues of the covariance: those of the scatter over n^2, rounded once
        self.e = np.array([float(v / n**2) for v in values])
        self.explained = [float(v / trace) if trace else None for v in values]
        self.live = np.array([v > 0 for v in values], bool)

    def whiten(self, y: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Projections over sqrt(eigenvalue) (NaN for eigenvalue 0), and deviations."""
        d, dev = distances(y, self.n, self.sums)
        centred = (d / self.n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            w = centred @ self.vectors.T / np.sqrt(self.e)[None, :]
        w[:, ~self.live] = np.nan
        return w, dev


def identity_error(vectors: DataFrame, model: Model, dims: int) -> float | None:
    """Largest entry of the whitened rows' covariance minus the identity (None without components)."""
    k = int(model.live.sum())
    if not k:
        return None

    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            w = model.whiten(entries(b.column("embedding"), dims))[0][:, model.live]
            w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "v"])

    rows = (vectors.select("embedding").mapInArrow(run, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())  # at most (k + 1)(k + 2) / 2 numbers
    at = {(r["i"], r["j"]): r["v"] / model.n for r in rows}
    return max(abs(at[i, j] - at[i, k] * at[j, k] - (i == j)) for i in range(k) for j in range(i, k))


def fit(vectors: DataFrame, k: int = COMPONENTS) -> tuple[Model, int] | None:
    """The whitening of ``usable`` rows and their length; None without rows."""
    spark = vectors.sparkSession
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if dims is None:
        return None
    if dims == 0:
        return Model(0, [], [], np.zeros((0, 0)), 0), 0
    n, sums, g = moments(vectors, dims)
    matrix = scatter(n, sums, g)
    values, found = components(spark, matrix, k)
    return Model(n, sums, values, found, sum(matrix[i][i] for i in range(dims))), dims


def whiten(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Each row's whitened value on each of the first ``k`` principal components.

    Result: see ``RESULT``, one row per usable row and component (all
    components if the vectors are shorter than ``k``). Entries c become
    x = floor(1024 c) + 100000. Rows with a NULL vector, or any NULL, NaN or
    infinite entry, are dropped; vectors shorter than the longest end in
    entries of 0; NULL vec_ids stay; repeated rows count and return as often
    as they come. ``deviation`` is NULL where the exact number leaves a long
    (``deviation_exact`` holds it up to 38 digits). A component with eigenvalue 0
    has a NULL ``whitened`` and takes no part in ``identity_error``, which is
    NULL if no component is left, as ``explained`` is where all rows are
    equal. Equal eigenvalues share a null space; an orthonormal basis of it is
    used. An empty table, or empty vectors only, give an empty result; further
    columns are ignored. Entries of 2**62 / 1024 and more raise ``ValueError``.
    """
    spark = rows.sparkSession
    prepare(spark)
    vectors = usable(rows)
    fitted = fit(vectors, k)
    if fitted is None or not len(fitted[0].e):
        return spark.createDataFrame([], RESULT)
    model, dims = fitted
    error = identity_error(vectors, model, dims)
    size = len(model.e)

    def run(batches):
        for b in batches:
            w, dev = model.whiten(entries(b.column("embedding"), dims))
            m = len(w)
            rep = np.repeat(np.arange(m), size)
            whitened = pa.array(w.ravel(), mask=~np.tile(model.live, m))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(rep)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)),
                pa.array(np.full(m * size, model.n)),
                pa.array([v if v < LONG else None for v in dev], pa.int64()).take(pa.array(rep)), whitened,
                pa.array(model.explained * m, pa.float64()), pa.array([error] * (m * size), pa.float64()),
                pa.array([Decimal(v) if v < 10**38 else None for v in dev], pa.decimal128(38, 0)).take(pa.array(rep))],
                names=[c.split()[0] for c in RESULT.split(", ")])

    return vectors.mapInArrow(run, RESULT)
