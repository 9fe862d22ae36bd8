"""Rows of vectors as whole numbers, for the operators that count and compare exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_numbers(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """vec_id, x (floor(scale * component) of each component as long), label if asked for, of every usable row.

    Rows whose vector is null, empty or holds null or non-finite components are dropped. What doesn't fit in a long is its
    nearest value.
    """
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    label = [F.col(label_col).cast("string").alias("label")] if label_col else []
    kept = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"), *label)


def lengths(rows: DataFrame) -> list[int]:
    """The lengths of x that occur, ascending; a number for each length passes the driver."""
    return sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of dim longs as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
