"""Whitening of embeddings by shifted CholeskyQR.

The principal axes of n centred rows X follow from the triangular factor of
X = QR.  R is found by passes over the rows: a distributed Gram matrix, its
Cholesky factor, and a triangular solve of the rows against it, again and again
until the solved rows are orthonormal.  The first factor is shifted, so that it
exists however ill-conditioned the rows are.  The factors' product is R, and the
singular value decomposition of that small matrix gives the axes and variances
without ever squaring the condition of X.

Only d x d figures reach the driver: one Gram matrix per pass, summed by Spark
row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import with_python
from stockloom.session import materialise

#: Share of the largest variance below which a component counts as having none.
FLAT = 1e-24
PASSES = 6


def usable(vector: Column) -> Column:
    """Not null and without null, NaN or infinite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """Whole numbers floor(scale * c)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Y with Y @ factor = rows for an upper triangular factor."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def gram(rows: DataFrame, vector: str, width: int, prepare) -> np.ndarray:
    """Sum over all rows of the outer products of ``prepare(matrix of rows)``.

    Every task adds up its own rows; its matrix leaves it as one row per line,
    and Spark adds the lines.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                y = prepare(_matrix(b.column(0), width))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["line", "g"])

    parts = rows.select(vector).mapInArrow(run, "line int, g array<double>")
    size = prepare(np.zeros((0, width))).shape[1]
    lines = parts.groupBy("line").agg(*[F.sum(F.col("g")[j]).alias(f"g{j}") for j in range(size)]).collect()
    out = np.zeros((size, size))
    for r in lines:
        out[r["line"]] = r[1:]
    return (out + out.T) / 2


def shifted_cholesky(g: np.ndarray, rows: int, always: bool) -> np.ndarray:
    """Upper factor of a Gram matrix; shifted in the first pass and wherever
    rounding leaves it indefinite (dependent columns)."""
    d = len(g)
    unit = np.finfo(float).eps / 2
    shift = 11 * (rows * d + d * (d + 1)) * unit * max(np.linalg.norm(g, 2), np.finfo(float).tiny)
    if not always:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


@dataclass
class Whitening:
    """The fit: row count, sums per dimension, axes (as columns) and variances."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        total = self.variances.sum()
        return self.variances / total if total > 0 else np.zeros_like(self.variances)

    @property
    def scales(self) -> np.ndarray:
        """1 / standard deviation; NaN for a component without variance."""
        v = self.variances
        real = v > FLAT * max(v.max(initial=0.0), np.finfo(float).tiny)
        return np.where(real, 1 / np.sqrt(np.where(real, v, 1.0)), np.nan)

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        return (x - self.mean) @ (self.axes[:, :components] * self.scales[:components])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sum)^2; null where it exceeds a long."""
        bound = self.n * max(1.0, float(np.abs(x.astype(float)).max(initial=0))) + max(map(abs, self.sums), default=0)
        if bound * bound * max(1, x.shape[1]) < 2.0 ** 62:
            gap = self.n * x - np.array(self.sums, np.int64)
            return (gap * gap).sum(1).tolist()
        out = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return [v if v < 2 ** 63 else None for v in out]


def fit(distinct: DataFrame, vector: str, width: int) -> Whitening | None:
    """Axes and variances of all rows of ``distinct`` (a stage); None if empty."""
    sums = distinct.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(vector)[j].cast("decimal(20,0)")).alias(f"s{j}") for j in range(width)]).first()
    n = sums["n"]
    if not n:
        return None
    totals = [int(s) for s in sums[1:]]
    mean = np.array([s / n for s in totals])
    factors: list[np.ndarray] = []

    def solved(x: np.ndarray) -> np.ndarray:
        y = x - mean
        for r in factors:
            y = solve_rows(y, r)
        return y

    product = np.eye(width)
    for i in range(PASSES):
        g = gram(distinct, vector, width, solved)
        if not g.any():
            break
        if i >= 2 and np.abs(g - np.eye(width)).max() < 1e-13 * width or i == PASSES - 1:
            break
        factors = [*factors, shifted_cholesky(g, n, always=i == 0)]
        product = factors[-1] @ product
    # What the last pass leaves of the identity belongs to R too; its root exists even
    # where columns depend on each other.
    size, turn = np.linalg.eigh(g)
    product = (np.sqrt(np.maximum(size, 0))[:, None] * turn.T) @ product
    _, s, vt = np.linalg.svd(product)
    axes = vt.T
    sign = np.sign(axes[np.abs(axes).argmax(0), range(width)])
    return Whitening(n, totals, axes * np.where(sign == 0, 1, sign), s * s / n)


def identity_error(distinct: DataFrame, vector: str, width: int, fitted: Whitening, components: int) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity,
    over the components that have a variance; null if none has."""
    real = np.flatnonzero(np.isfinite(fitted.scales[:components]))
    if not len(real):
        return None

    def with_one(x: np.ndarray) -> np.ndarray:
        z = fitted.project(x, components)[:, real]
        return np.hstack([z, np.ones((len(z), 1))])

    g = gram(distinct, vector, width, with_one) / fitted.n
    mean = g[:-1, -1]  # 0 but for rounding, since rows are centred
    return float(np.abs(g[:-1, :-1] - np.outer(mean, mean) - np.eye(len(real))).max())


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened,
    explained, identity_error.

    Unusable: a null vector, or one with null, NaN or infinite entries; also
    one whose length is not the commonest (of two equally common the larger),
    as it has no place in the space.  The fit takes each distinct quantised
    vector once, so copies do not weigh.  A component without variance (fewer
    than two distinct vectors, dependent dimensions) has a null ``whitened``;
    with fewer dimensions than ``components`` there are as many as dimensions.
    ``deviation`` is null where it exceeds a long.  An empty table, or one
    without usable rows, gives no rows.  Null and repeated ids are rows like
    others; other columns are ignored.
    """
    spark = df.sparkSession
    source = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    common = source.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    kind = df.schema[id_col].dataType.simpleString()
    if common is None or common["d"] == 0:
        return spark.createDataFrame([], f"`{id_col}` {kind}, {schema}")
    width = common["d"]
    rows = source.where(F.size("v") == width).select("id", quantised(F.col("v"), scale).alias("x"))
    distinct = materialise(rows.select("x").distinct(), "whitening-fit")
    fitted = fit(distinct, "x", width)
    count = min(components, width)
    error = identity_error(distinct, "x", width, fitted, count)
    share = [float(e) for e in fitted.explained[:count]]

    def place(b: pa.RecordBatch) -> dict[str, list]:
        x = _matrix(b.column("x"), width)
        z = fitted.project(x, count)
        return {"deviation": fitted.deviation(x), "z": list(z)}

    made = with_python(rows, place, "deviation long, z array<double>", drop=("x",))
    out = made.select("id", "deviation", F.posexplode("z").alias("at", "w"))
    return out.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
        F.nanvl("w", F.lit(None).cast("double")).alias("whitened"),
        F.element_at(F.array(*[F.lit(e) for e in share]), F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
