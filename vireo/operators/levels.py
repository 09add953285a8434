"""Totals on several levels from one pass: grouping sets over a pre-aggregated grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouping_levels(df: DataFrame, dims: list[str], sums: dict[str, Column], sets: list[list[str]]) -> DataFrame:
    """One row per group of every level in ``sets``: ``dims`` (null above their level), the sums, and ``level``.

    The rows are aggregated once to the finest grain, pre-reduced in the map tasks; only grain rows are
    multiplied by the levels.  ``level`` is the grouping id (a bit for each dimension that is summed over, first
    dimension highest), which tells a level's total from a group whose value is null.
    """
    grain = df.groupBy(*dims).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    levels = grain.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims])
    return levels.agg(*[F.sum(n).alias(n) for n in sums], F.grouping_id().cast("int").alias("level"))


def rollup_sets(dims: list[str]) -> list[list[str]]:
    return [dims[:n] for n in range(len(dims), -1, -1)]


def cube_sets(dims: list[str]) -> list[list[str]]:
    return [[d for i, d in enumerate(dims) if not mask >> (len(dims) - 1 - i) & 1] for mask in range(1 << len(dims))]
