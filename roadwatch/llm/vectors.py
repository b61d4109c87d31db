"""Vectors as rows: which take part, and their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(v: Column) -> Column:
    """Not NULL and every component present and finite."""
    bad = F.exists(v.cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch by the length of their vectors."""
    size = pc.list_value_length(batch.column(column))
    lengths = pc.unique(size).to_pylist()
    for d in lengths:
        yield d, batch if len(lengths) == 1 else batch.filter(pc.equal(size, d))


def usable(v: Column) -> Column:
    """Not NULL, every component present and finite, and some component not zero."""
    d = v.cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(d, lambda x: x != 0), F.lit(False))


def lengths(df: DataFrame, vec_col: str) -> list[int]:
    """The lengths of the usable vectors, rising. Vectors of different lengths have no
    cosine; the operators take each length on its own."""
    return sorted(r.d for r in df.where(usable(F.col(vec_col))).select(F.size(vec_col).alias("d")).distinct().collect())


def matrix(column) -> np.ndarray:
    """An Arrow list column without NULLs as a two-dimensional array of doubles."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), len(flat) // len(column)) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 (scaled first, so that very large and small ones keep their direction)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, summed in the same order for equal rows."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
