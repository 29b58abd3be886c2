"""Helpers for operators on vectors: rows of an Arrow list column as matrices, and the width."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_width(df: DataFrame, vector: str) -> int:
    """The length that most vectors have (the greater of two equally frequent ones); 0 without any."""
    sizes = df.select(F.size(vector).alias("size")).where("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    found = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return found[0]["size"] if found else 0


def finite_rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of ``width`` finite entries, and those vectors as a double matrix."""
    of_width = pc.equal(pc.list_value_length(column), width).fill_null(False)
    rows = column.filter(of_width).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    finite = np.isfinite(rows).all(axis=1)
    return np.flatnonzero(of_width.to_numpy(zero_copy_only=False))[finite], rows[finite]


def best(owner: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Places of each owner's first ``most`` entries: by falling score, then id, then row."""
    order = np.lexsort((row, id_, -score, owner))
    first = np.flatnonzero(np.diff(owner[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[rank < most]
