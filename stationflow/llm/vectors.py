"""Vectors in tables as matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_INFINITY = float("inf")


def usable(vectors: DataFrame, vector_col: str, *more: Column) -> tuple[DataFrame, int]:
    """(rows, length): ``more`` columns and ``_v``, the vectors that take part, as doubles.

    A vector takes part if it is there, every component is finite and its length is the
    one that most such vectors have, of several the greatest. Length 0: there is none.
    """
    rows = vectors.select(*more, F.col(vector_col).cast("array<double>").alias("_v"))
    rows = rows.filter(F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _INFINITY)) & (F.size("_v") > 0))
    length = rows.groupBy(F.size("_v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if length is None:
        return rows, 0
    return rows.filter(F.size("_v") == length["length"]), length["length"]


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a batch, a row each."""
    if not len(column):
        return np.zeros((0, length))
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].reshape(len(column), length)
