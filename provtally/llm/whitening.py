"""Whitening of embedding vectors by a blockwise QR and a bidiagonal qd solver.

Vectors become grids of whole numbers, so counts and sums are exact. The distinct ones are the fit
list: each task reduces its centred rows to one triangular factor, batch by batch, and factors are
stacked and reduced again in rounds of bounded fan-in, which never forms a product of
the rows with themselves. The driver holds one factor of d x d values and solves it (see bidiagonal).
Every row is then projected in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.llm.bidiagonal import principal
from provtally.llm.common import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Factors that one task stacks in a round.
FAN_IN = 64
#: Values of this size and more do not fit the grid.
_MOST = float(2**56)


@dataclass(frozen=True)
class Whitening:
    """Directions, their eigenvalues and what they were fitted on; ``vectors`` has a column for each component."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry as long; null for a vector that is null or empty or has an entry without such a value."""
    entries = vector.cast("array<double>")
    scaled = lambda c: c * F.lit(float(scale))
    sound = (F.size(entries) > 0) & F.forall(entries, lambda c: F.coalesce(F.abs(scaled(c)) < F.lit(_MOST), F.lit(False)))
    return F.when(sound, F.transform(entries, lambda c: F.floor(scaled(c)) + F.lit(shift)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from the whole number n*x - S where that fits."""
    if float(n) * max(float(np.abs(x).max(initial=0)), 1.0) < 2.0**62:
        return (x * n - sums) / n
    wide = x.astype(object) * n - np.array([int(s) for s in sums], dtype=object)
    return np.array([[float(v) / n for v in row] for row in wide], dtype=np.float64).reshape(x.shape)


def _summing(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            # Halves of each number, so that no sum of a batch leaves 64 bits.
            high, low = (x >> 31).sum(axis=0), (x & ((1 << 31) - 1)).sum(axis=0)
            sums = [s + (int(h) << 31) + int(v) for s, h, v in zip(sums, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(s) for s in sums]], pa.list_(pa.string()))], names=["n", "sums"])

    return run


def _factoring(d: int, n: int, sums: np.ndarray):
    """One triangular factor for all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            if batch.num_rows:
                r = np.linalg.qr(np.vstack((r, _centred(_matrix(batch.column(0), d), n, sums))), mode="r")
        if len(r):
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "r"])

    return run


def _stacking(d: int):
    """One factor for each part from the factors of its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, flat in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = np.array(flat.values).reshape(-1, d)
                found[part] = np.linalg.qr(np.vstack((found.get(part, rows[:0]), rows)), mode="r")
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int32()), pa.array([r.ravel().tolist() for r in found.values()], pa.list_(pa.float64()))], names=["part", "r"]
            )

    return run


def _factor(fit_list: DataFrame, d: int, n: int, sums: np.ndarray) -> np.ndarray:
    """The d x d factor R of the centred fit list, RᵀR being n times its covariance."""
    schema = "part int, r array<double>"
    factors = stored(fit_list.mapInArrow(_factoring(d, n, sums), schema), "factors")
    while (count := factors.count()) > FAN_IN:
        parts = -(-count // FAN_IN)
        dealt = factors.withColumn("part", F.pmod("part", F.lit(parts)).cast("int")).repartition(parts, "part")
        factors = stored(dealt.mapInArrow(_stacking(d), schema), "factors")
    r = np.zeros((0, d))
    for row in factors.orderBy("part").toLocalIterator():
        r = np.linalg.qr(np.vstack((r, np.array(row["r"]).reshape(-1, d))), mode="r")
    return np.vstack((r, np.zeros((d - len(r), d))))


def _whitened(x: np.ndarray, fitted: Whitening) -> np.ndarray:
    centred = _centred(x, fitted.n, np.array(fitted.sums, dtype=object if max(map(abs, fitted.sums)) >= 2**62 else np.int64))
    out = np.zeros((len(x), len(fitted.values)))
    # Dimension by dimension, so that a row's sums do not depend on the rows beside it.
    for column, direction in zip(centred.T, fitted.vectors, strict=True):
        out += column[:, None] * direction
    return out / np.sqrt(fitted.values)


def _squaring(fitted: Whitening):
    """A task's sum of products of whitened components."""
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = _whitened(_matrix(batch.column(0), fitted.dimensions), fitted)
            total += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "v"])

    return run


def fit(grids: DataFrame, column: str = "x", components: int = COMPONENTS) -> Whitening | None:
    """Directions of the distinct vectors of ``grids``, which all have one length; None without a row.

    Components whose eigenvalue is zero up to rounding are left out, so constant or copied dimensions
    and lists of fewer vectors than dimensions give fewer than asked for.
    """
    fit_list = stored(grids.select(F.col(column).alias("x")).distinct(), "fit")
    first = fit_list.head()
    if first is None:
        return None
    d = len(first["x"])
    partial = fit_list.mapInArrow(_summing(d), "n long, sums array<string>")
    exact = partial.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at")
    rows = exact.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    n, sums = rows[0]["n"], tuple(int(r["s"]) for r in rows)
    large = max(map(abs, sums)) >= 2**62
    r = _factor(fit_list, d, n, np.array(sums, dtype=object if large else np.int64))
    squares, vectors, trace = principal(r, components)
    fitted = Whitening(n, sums, squares / n, vectors, trace / n, 0.0)
    if not len(squares):
        return fitted
    products = fit_list.mapInArrow(_squaring(fitted), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    error = products.agg(F.max(F.abs(F.col("v") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]
    return Whitening(n, sums, squares / n, vectors, trace / n, float(error))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum of (n*x - S)² of each row, exact; null where it leaves 64 bits."""
    low, high = x.min(axis=0, initial=0), x.max(axis=0, initial=0)
    most = max(max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(low, high, sums, strict=True))
    widest = n * max(abs(int(low.min())), abs(int(high.max())))
    if most * most * len(sums) < 2**63 and widest < 2**63 and max(map(abs, sums)) < 2**63:
        return ((x * n - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def _projecting(fitted: Whitening, kind: pa.DataType):
    k, explained = len(fitted.values), fitted.values / fitted.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 4096):
                batch = whole.slice(first, 4096)
                x, rows = _matrix(batch.column(1), fitted.dimensions), batch.num_rows
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(kind).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, fitted.n, dtype=np.int64)),
                        pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64()).take(each),
                        pa.array(_whitened(x, fitted).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * k, fitted.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def gridded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and grid x of the vectors that have one and share the commonest length (of equally common ones the largest)."""
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), grid(F.col(vector_col)).alias("x")).where("x is not null")
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return kept.where(F.size("x") == (commonest[0]["d"] if commonest else 0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened components of each vector: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, hold a null, non-finite or huge entry, or have another length than
    most are dropped. Rows of one id, or of none, are rows of their own; equal vectors count once in the
    fit and get equal values. Components run from 1 by falling eigenvalue, fewer than asked for where
    the vectors span less; a table without spread, or empty, gives no rows. ``deviation`` is null where it
    leaves 64 bits. Directions of equal eigenvalues are one choice among many. Other columns are not read.
    """
    grids = gridded(vectors, id_col, vector_col)
    fitted = fit(grids, "x", components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], schema)
    return grids.mapInArrow(_projecting(fitted, pa.int64()), schema)
