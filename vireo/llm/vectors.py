"""Vectors as rows: which ones take part, one per id, and their Arrow form in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, all components finite, not all zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def one_per_id(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the usable vectors; of rows that repeat an id the smallest vector (component by component) stands."""
    kept = rows.where(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return kept.groupBy("id").agg(F.min("v").alias("v"))


def by_dimension(column: pa.Array):
    """(row numbers, matrix in double precision) for each vector length in an Arrow list column."""
    sizes = np.asarray(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[(ends[rows] - d)[:, None] + np.arange(d)[None, :]]
