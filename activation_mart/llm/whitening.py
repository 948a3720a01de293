"""Embedding whitening: principal components of an exact covariance, refined from float32 to double."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

COMPONENTS = 16
SCALE = 64  # grid steps in a unit of an entry
ORIGIN = 1_000_000  # grid value of 0
LIMIT = float(1 << 31)  # grid steps that an entry may have
EXACT = 1 << 53  # integers below are exact in float64
ROUNDS = 30
SETTLED = 1e-12  # a correction this small squares to less than any precision used
STALLED = 1e-6  # corrections below this that no longer shrink are rounding


def on_grid(frame: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows whose vector has finite entries only, with ``__grid``: floor(scale * entry) of each."""
    entries = F.col(vector).cast("array<double>")
    usable = F.forall(entries, lambda e: e.isNotNull() & (F.abs(e * scale) < LIMIT))
    steps = F.transform(entries, lambda e: F.floor(e * scale).cast("int"))
    return frame.filter(usable & (F.size(entries) > 0)).withColumn("__grid", steps)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal lists of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _sums(grid: DataFrame, width: int) -> list[int]:
    """Exact sum of each dimension; each task sends one row a dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["i", "s"])

    rows = grid.select("__grid").mapInArrow(added, "i int, s bigint")
    sums = rows.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one row a dimension
    found = {row["i"]: int(row["s"]) for row in sums}
    return [found[i] for i in range(width)]


def exact_products(rows: np.ndarray) -> np.ndarray:
    """rows.T @ rows of integers, as Python integers."""
    width = rows.shape[1]
    total = np.zeros((width, width), object)
    if not len(rows):
        return total
    most = max(1, int(np.abs(rows).max()))
    if most * most >= EXACT:
        wide = rows.astype(object)
        return wide.T @ wide
    step = min(len(rows), EXACT // (most * most))
    for low in range(0, len(rows), step):
        part = rows[low : low + step].astype(np.float64)  # every sum stays below EXACT
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _products(grid: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sums of the products of centred entries; each task sends one row a pair of dimensions."""
    width = len(centre)
    upper = np.triu_indices(width)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            if batch.num_rows:
                total += exact_products(_matrix(batch.column(0)) - centre)
        cells = pa.array([Decimal(int(v)) for v in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), cells], names=["i", "j", "g"]
        )

    rows = grid.select("__grid").mapInArrow(multiplied, "i int, j int, g decimal(38,0)")
    out = np.zeros((width, width), object)
    for row in rows.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():  # one row a pair of dimensions
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = int(row["g"])
    return out


def _clusters(values: np.ndarray, apart: float) -> Iterator[np.ndarray]:
    """Groups of two or more eigenvalues that no gap above ``apart`` separates."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    yield from (group for group in np.split(order, cuts) if len(group) > 1)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    The float32 eigenvectors X start an iteration of matrix products in the
    widest float there is (Ogita and Aishima): with R = I - X'X and S = X'AX,
    the correction X E has E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i]),
    and R[i, j] / 2 where the eigenvalues l are too close for what S and R still
    hold of error. Its error squares each round. The vectors of such a cluster
    span the right space but are mixed: a sub-problem over them alone, moved to
    the cluster's mean and hence exact in its small differences, separates them.
    Equal eigenvalues keep any orthonormal basis. The entry of largest
    magnitude of each vector is positive.
    """
    size = len(matrix)
    a = np.asarray(matrix, np.longdouble)
    norm = np.sqrt((a * a).sum())
    if not size or norm == 0:
        return np.zeros(size), np.eye(size)
    a = a / norm
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one, rounding = np.eye(size, dtype=np.longdouble), size * np.finfo(np.longdouble).eps
    before = np.inf
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else rounding over a small gap would undo that x is orthogonal
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        apart = max(2 * (np.sqrt((off * off).sum()) + np.sqrt((r * r).sum())), rounding)
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= apart
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gaps))
        x = x + x @ e
        correction = np.abs(e).max()
        for group in _clusters(values, apart):
            part = x[:, group]
            inner = part.T @ (a @ part - values[group].mean() * part)
            inner = (inner + inner.T) / 2
            spread = np.abs(inner).max()
            if spread > rounding:
                turn = np.linalg.eigh((inner / spread).astype(np.float64))[1]
                x[:, group] = part @ turn.astype(np.longdouble)
                if np.abs(inner - np.diag(np.diag(inner))).max() > rounding:
                    correction = max(correction, np.longdouble(1))
        if correction <= SETTLED or before < STALLED and correction > before / 2:
            break  # what is left is rounding, as turns within a cluster that changes nothing else
        before = correction
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(size)] < 0, -1, 1)
    return (values[order] * norm).astype(np.float64), x.astype(np.float64)


@dataclass
class Whitening:
    """A fitted transform: rows are centred, projected on ``vectors`` and scaled to unit variance."""

    n: int  # distinct grid vectors
    centre: np.ndarray  # integer next to the mean of each dimension
    excess: list[int]  # exact sum of (grid - centre)
    values: np.ndarray  # variances along the components, falling
    vectors: np.ndarray  # components, as columns
    total: float  # sum of all variances
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.total if self.total > 0 else np.zeros(len(self.values))

    def apply(self, grid: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without variance is NaN."""
        moved = (grid - self.centre).astype(np.float64) - np.array([e / self.n for e in self.excess])
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (moved @ self.vectors) * scale

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n x - S)^2; None where it exceeds a long."""
        moved = grid - self.centre
        bound = self.n * int(np.abs(moved).max(initial=0)) + max(map(abs, self.excess), default=0)
        if bound * bound * grid.shape[1] < 1 << 63:
            return ((self.n * moved - np.array(self.excess, np.int64)) ** 2).sum(axis=1).tolist()
        sums = ((moved.astype(object) * self.n - np.array(self.excess, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in sums]


def _identity_error(grid: DataFrame, fitted: Whitening) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|."""
    kept = np.flatnonzero(fitted.values > 0)
    if not len(kept):
        return 0.0

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(kept), len(kept)))
        for batch in batches:
            if batch.num_rows:
                rows = fitted.apply(_matrix(batch.column(0)))[:, kept]
                total += rows.T @ rows
        i, j = np.indices(total.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "g"])

    sums = grid.select("__grid").mapInArrow(multiplied, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    same = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return sums.agg(F.max(F.abs(F.col("g") / fitted.n - same))).first()[0]


def fit(frame: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """Whitening of the distinct vectors of a frame on a grid of 1 / ``scale``; None without a vector.

    Vectors are integers on the grid, so sums and products are exact and do not
    depend on how rows are dealt or on a task that runs again. Entries are
    centred on the integer below the mean before they are multiplied, and the
    remainder is taken out of the sums. What the driver holds grows with the
    square of the dimension, not with the rows.

    NULL vectors, empty ones, and such with a NULL, NaN, infinite entry, or one
    of 2^31 grid steps or more, are not used; of several lengths the most
    frequent counts, the shorter in a tie.
    """
    distinct = settle(on_grid(frame.select(vector), vector, scale).select("__grid").distinct(), "grid")
    lengths = distinct.groupBy(F.size("__grid").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "width").first()
    if first is None:
        return None
    width, n = first["width"], first["n"]
    used = distinct.filter(F.size("__grid") == width)
    sums = _sums(used, width)
    centre = np.array([s // n for s in sums], np.int64)
    excess = [s - n * int(c) for s, c in zip(sums, centre)]
    remainder = np.array(excess, object)
    covariance = n * _products(used, centre) - np.outer(remainder, remainder)  # n^2 times it, exact
    values, vectors = eigen(covariance.astype(np.longdouble) / np.longdouble(n) / np.longdouble(n))
    total = float(sum(int(v) for v in np.diag(covariance)) / n**2)
    values = np.where(values > width * np.finfo(np.float64).eps * values.max(initial=0), values, 0.0)
    fitted = Whitening(n, centre, excess, values[:components], vectors[:, :components], total)
    fitted.identity_error = _identity_error(used, fitted)
    return fitted


def whiten(
    frame: DataFrame, fitted: Whitening | None, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(key, deviation, whitened) of every row whose vector is usable and of the fitted length.

    ``whitened`` has one entry a component, NULL where the component has no
    variance. Repeated rows and rows without a key each give a row; other
    columns are not read.
    """
    kind = frame.schema[key].dataType.simpleString()
    schema = f"key {kind}, deviation bigint, whitened array<double>"
    rows = on_grid(frame.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector", scale)
    if fitted is None:
        return frame.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    width = len(fitted.centre)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = _matrix(batch.column(1))
            out = fitted.apply(grid)
            flat = pa.array(out.ravel(), pa.float64(), from_pandas=True)  # NaN to NULL
            offsets = np.arange(0, out.size + 1, max(1, out.shape[1]), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fitted.deviations(grid), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                names=["key", "deviation", "whitened"],
            )

    rows = rows.filter(F.size("__grid") == width).select("key", "__grid")
    return rows.mapInArrow(projected, schema).withColumnRenamed("key", key)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    fitted = fit(vectors)
    rows = whiten(vectors, fitted)
    explained = [] if fitted is None else fitted.explained.tolist()
    shares = F.array(*map(F.lit, explained)) if explained else F.lit(None).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, "at").alias("explained"),
        F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"),
    )
