"""Embedding whitening by shifted CholeskyQR.

Vectors are put on a fixed-point grid, so that their sums, means and centred rows do not
depend on the order of partial sums. A Gram pass adds up Q'Q of the centred rows, task by
task, and Spark sums the cells; its Cholesky factor R_k orthogonalises the rows of the next
pass by a triangular solve, and the factors compose to R = R_k ... R_1, so that X = Q R.
The first factor is of the Gram matrix plus a small shift, which keeps it positive definite
for nearly dependent columns; each further pass squares the distance from orthogonality.
The SVD of the small R then gives the components and singular values of all rows.

Only matrices of width x width reach the driver; no pass shuffles rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import pick
from shelfwise.llm.vectors import common_width, finite_rows

#: The fixed-point grid: x = floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Below this distance from orthogonality the last factor leaves an error of its square.
ORTHOGONAL = 1e-7
MAX_PASSES = 12
#: Directions in which orthogonalised rows have less than this share of a unit have no variance.
NO_VARIANCE = 1e-10


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``axes`` holds the components as columns, ``eigenvalues`` their
    variances; ``sums / n`` is the mean of the grid vectors."""

    width: int
    n: int
    sums: np.ndarray
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    passes: int
    scale: int = SCALE
    offset: int = OFFSET

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """``n * x - sum of all x`` for each row, exactly."""
        return self.n * on_grid(rows, self.scale, self.offset) - self.sums

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.deviations(rows) / self.n @ (self.axes / np.sqrt(self.eigenvalues))


def on_grid(rows: np.ndarray, scale: int, offset: int) -> np.ndarray:
    grid = np.floor(scale * rows)
    if len(grid) and np.abs(grid).max() >= 1 << 31:
        raise OverflowError("entries beyond the fixed-point grid: take a smaller scale")
    return grid.astype(np.int64) + offset


def summed(df: DataFrame, vector: str, width: int, totals: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of ``totals(rows)`` over all vectors: added up in each task, then cell by cell by Spark."""
    def run(batches):
        held = None
        for b in batches:
            _, rows = finite_rows(b.column(0), width)
            if len(rows):
                held = totals(rows) if held is None else held + totals(rows)
        if held is not None:
            flat = held.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["cell", "value"])

    cells = df.select(vector).mapInArrow(run, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    found = sorted(cells.collect())
    return np.array([r["value"] for r in found])


def orthogonalised(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper triangular factor in turn."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Components and variances of all usable vectors of ``df``, or None without variance.

    Null vectors, those with null or non-finite entries and those whose length is not the
    most frequent one take no part. Repeated rows count each time. The table is read once
    for each pass, the vector column only.
    """
    df = pick(df, vector)
    width = common_width(df, vector)
    if not width:
        return None
    found = summed(df, vector, width, lambda rows: np.append(on_grid(rows, scale, offset).sum(axis=0), len(rows)), "long")
    if not len(found):
        return None
    n, sums = int(found[-1]), found[:-1].astype(np.int64)

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def of(rows: np.ndarray) -> np.ndarray:
            q = orthogonalised((n * on_grid(rows, scale, offset) - sums) / n, factors)
            return q.T @ q
        return summed(df, vector, width, of, "double").reshape(width, width)

    first = gram([])
    if not (trace := np.trace(first)) > 0:
        return None
    shift = 11 * (n * width + width * (width + 1)) * np.finfo(float).eps / 2 * trace
    factors = [np.linalg.cholesky(first + shift * np.eye(width)).T]
    for _ in range(MAX_PASSES):
        g = gram(factors)
        size, turn = np.linalg.eigh(g)
        empty = turn[:, size < NO_VARIANCE]
        full = g + empty @ empty.T  # unit rows where there are none, so that a factor exists
        factors.append(np.linalg.cholesky(full).T)
        if np.abs(full - np.eye(width)).max() < ORTHOGONAL:
            break
    r = np.linalg.multi_dot([*factors[::-1], np.eye(width)])
    r -= empty @ (empty.T @ r)
    _, singular, turn = np.linalg.svd(r)
    eigenvalues = singular ** 2 / n
    keep = min(components, int((singular > 1e-13 * singular[0]).sum()))
    return Whitening(width, n, sums, turn[:keep].T, eigenvalues[:keep], eigenvalues[:keep] / eigenvalues.sum(), len(factors),
                     scale, offset)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity. The rows'
    mean is zero but for rounding, and what is left of it is taken off as well."""
    def of(rows: np.ndarray) -> np.ndarray:
        z = model.whitened(rows)
        return np.vstack([z.T @ z, z.sum(axis=0)])
    found = summed(pick(df, vector), vector, model.width, of, "double").reshape(-1, model.axes.shape[1]) / model.n
    return float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(found) - 1)).max())


def squared(deviations: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exactly; an error where one does not fit a long."""
    if len(deviations) and float(np.abs(deviations).max()) ** 2 * deviations.shape[1] >= 2.0 ** 62:
        exact = [sum(v * v for v in row) for row in deviations.tolist()]
        return np.array(exact, np.int64)
    return (deviations ** 2).sum(axis=1)


RESULT = "n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, model: Whitening | None = None, id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error): one for each
    usable vector of ``df`` and component, numbered from 1 by falling variance.

    ``deviation`` is the sum over dimensions of ``(n * x - sum of all x) ** 2`` on the grid,
    ``explained`` the component's share of all variance, ``identity_error`` one value, of the
    rows of ``df``. Without a ``model`` it is fitted on ``df`` itself.

    Null and repeated ids are rows like others. Vectors that are null, hold null or
    non-finite entries or have another length give no row. Fewer components are returned
    where fewer have any variance; an empty table, or equal vectors only, give no rows.
    Other columns are not read.
    """
    df = pick(df, id, vector)
    kind = df.schema[id].dataType.simpleString()
    model = model or fit(df, vector, components, scale, offset)
    if model is None:
        return df.sparkSession.createDataFrame([], f"{id} {kind}, component int, {RESULT}")
    error = identity_error(df, model, vector)

    def run(batches):
        count = len(model.eigenvalues)
        for b in batches:
            at, rows = finite_rows(b.column(1), model.width)
            deviation = squared(model.deviations(rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(at, count))),
                 pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                 pa.array(np.full(count * len(at), model.n)),
                 pa.array(np.repeat(deviation, count)),
                 pa.array(model.whitened(rows).ravel()),
                 pa.array(np.tile(model.explained, len(at))),
                 pa.array(np.full(count * len(at), error))],
                [id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.mapInArrow(run, f"{id} {kind}, component int, {RESULT}")
