"""Vectors fit for comparison, and their Arrow form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not NULL, not empty, not zero, every component a finite number."""
    entry = F.col(vector).cast("array<double>")
    finite = F.forall(entry, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(entry, lambda x: x != 0), F.lit(False))


def clean_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, dims) of the usable rows with an id; a row repeated exactly counts once."""
    named = df.where(usable(vector) & F.col(vec_id).isNotNull())
    named = named.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return named.withColumn("dims", F.size("v"))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dims`` entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64, copy=False)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component is taken out first, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
