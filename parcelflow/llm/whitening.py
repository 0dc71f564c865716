"""Whitening of embeddings by an incremental eigendecomposition.

The mean is exact: sums of integers. Then each partition keeps the spectrum of its rows' scatter
about that mean by centred rank-one updates; spectra of partitions are combined in rounds, again
by rank-one updates. A last pass over the rows refines the basis by Rayleigh-Ritz: the covariance
of the rows in that basis, dim x dim numbers, is nearly diagonal, and its eigenvectors turn it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import spectrum
from parcelflow.llm.common import staged

COMPONENTS = 8
#: Fixed values of the contract: steps in a unit, and what makes entries positive.
SCALE, SHIFT = 1024, 100_000
#: Entries are held to this many steps, so that they and their sums stay exact.
LARGEST = 1 << 52
#: Rows whose scatter is put into one triangular factor before it updates the spectrum.
BLOCK = 4096
#: Spectra combined by one task in each round.
FAN_IN = 8
#: Components with a smaller share of the largest eigenvalue have no variance beyond rounding.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """n rows with sums `total`; eigenvalues falling, eigenvectors as columns; trace of the covariance."""

    n: int
    total: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total])

    def factors(self, components: int) -> np.ndarray:
        """Columns that give whitened components of centred rows; zero where there is no variance."""
        some = self.values[:components] > NO_VARIANCE * max(self.values[0], 0)
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.values[:components], 1)), 0)
        return self.vectors[:, :components] * scale


def stepped(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): the rows that take part, as integers, in a written table.

    Vectors that are null or hold null or non-finite entries take no part, nor do those of another
    length than most have (of equally frequent lengths the smaller counts) and empty ones.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(F.col("v").isNotNull() & finite & (F.size("v") > 0))
    sizes = valid.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = sizes.dim if sizes else 0
    step = lambda c: F.least(F.greatest(F.floor(c * SCALE), F.lit(-LARGEST)), F.lit(LARGEST)) + SHIFT
    return staged(valid.where(F.size("v") == dim).select("id", F.transform("v", lambda c: step(c).cast("long")).alias("x")), "stepped")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield _matrix(batch.slice(at, BLOCK))


def sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """(n, sum per dimension), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(batches):
            # Two halves of the digits, so that a block's sums fit.
            high, low = x >> 26, x & ((1 << 26) - 1)
            d = x.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d)), pa.array(np.full(d, len(x))), pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))],
                ["dim", "n", "high", "low"],
            )

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    per_dim = rows.select("x").mapInArrow(run, "dim long, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), wide("high"), wide("low"))
    found = sorted(per_dim.collect())
    return (found[0].n if found else 0), tuple((int(r.high) << 26) + int(r.low) for r in found)


def _spectra(rows: DataFrame, mean: np.ndarray) -> DataFrame:
    """(number, d, u): eigenvalues and eigenvectors of each partition's scatter about the mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        d, u = spectrum.empty(len(mean))
        seen = False
        for x in _blocks(batches):
            d, u = spectrum.with_rows(d, u, x - mean)
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([d.tolist()]), pa.array([u.ravel().tolist()])], ["number", "d", "u"]
            )

    return staged(rows.select("x").mapInArrow(run, "number long, d array<double>, u array<double>"), "spectra")


def _combined(spectra: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """One spectrum of all, FAN_IN into one in each round."""

    def merge(group: pa.Table) -> pa.Table:
        held = None
        for row in group.sort_by("number").to_pylist():
            one = np.array(row["d"]), np.array(row["u"]).reshape(dim, dim)
            held = one if held is None else spectrum.combined(held, one)
        number = group.column("group")[0].as_py()
        return pa.table({"number": pa.array([number], pa.int64()), "d": [held[0].tolist()], "u": [held[1].ravel().tolist()]})

    most = spectra.agg(F.max("number")).first()[0]
    while most > 0:
        grouped = spectra.withColumn("group", F.floor(F.col("number") / FAN_IN))
        spectra = staged(grouped.groupBy("group").applyInArrow(merge, "number long, d array<double>, u array<double>"), "spectra")
        most //= FAN_IN
    row = spectra.first()
    return np.array(row.d), np.array(row.u).reshape(dim, dim)


def _covariance(rows: DataFrame, mean: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    """Covariance of the centred rows' coordinates in the basis, centred once more; each task sends a triangle."""
    k = basis.shape[1]
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, seen = np.zeros(k), np.zeros((k, k)), False
        for x in _blocks(batches):
            y = (x - mean) @ basis
            first += y.sum(axis=0)
            second += y.T @ y
            seen = True
        if seen:
            values = np.r_[first, second[upper]]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["entry", "value"])

    summed = rows.select("x").mapInArrow(run, "entry long, value double").groupBy("entry").agg(F.sum("value").alias("value"))
    found = np.array([r.value for r in summed.orderBy("entry").collect()])
    matrix = np.zeros((k, k))
    matrix[upper] = found[k:] / n
    matrix = matrix + matrix.T - np.diag(matrix.diagonal())
    away = found[:k] / n
    return matrix - np.outer(away, away)


def fit(rows: DataFrame) -> Whitening | None:
    """Whitening of stepped rows; None without rows. The driver takes sums and one dim x dim matrix."""
    n, total = sums(rows)
    if not n:
        return None
    mean = np.array([s / n for s in total])
    spectra = _spectra(rows, mean)
    _, u = _combined(spectra, len(mean))
    basis = np.linalg.qr(u)[0]
    ritz, turn = np.linalg.eigh(_covariance(rows, mean, basis, n))
    vectors = (basis @ turn)[:, ::-1]
    # Either sign is right; this one makes reruns agree.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(mean))] < 0, -1, 1)
    return Whitening(n, total, np.maximum(ritz[::-1], 0), vectors, float(ritz.sum()))


def identity_error(rows: DataFrame, fitted: Whitening, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, of the components with variance."""
    factors = fitted.factors(components)
    some = np.flatnonzero(factors.any(axis=0))
    if not len(some):
        return 0.0
    found = _covariance(rows, fitted.mean, factors[:, some], fitted.n)
    return float(np.abs(found - np.eye(len(some))).max())


def _deviation(x: np.ndarray, n: int, total: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2, exact; None where it doesn't fit a long."""
    sums_of = np.array(total, dtype=object)
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    reach = max(abs(n * v - s) for s in total for v in (low, high))
    if reach * reach * len(total) < 1 << 63 and n * max(abs(low), abs(high)) < 1 << 63 and max(map(abs, total)) < 1 << 63:
        away = x * n - sums_of.astype(np.int64)
        return (away * away).sum(axis=1).tolist()
    away = x.astype(object) * n - sums_of
    return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()]


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row that takes part and component.

    Null ids and repeated rows take part like others. Vectors with nulls, NaN or infinities, and of
    another length than most, are left out, and so are all of an empty table. A component without
    variance gives 0 for whitened and explained, and doesn't count for identity_error. A deviation beyond a long is
    null. Other columns are not read.
    """
    rows = stepped(vectors, id_col, vector_col)
    fitted = fit(rows)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, total, mean, factors = fitted.n, fitted.total, fitted.mean, fitted.factors(components)
    k = factors.shape[1]
    explained = np.where(factors.any(axis=0), fitted.values[:k] / (fitted.trace or 1), 0.0)
    error = identity_error(rows, fitted, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x, count = _matrix(part), part.num_rows
                own = pa.array(np.repeat(np.arange(count), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(own), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n)), pa.array(_deviation(x, n, total), pa.int64()).take(own),
                        pa.array(((x - mean) @ factors).ravel()), pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)
