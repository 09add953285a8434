"""Turning one aggregated row into several without re-running its plan.

``unionByName`` of several selects over the same aggregate repeats the
aggregate's subtree in the plan; exploding an array of structs built from
that one row reads it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_from(df: DataFrame, rows: list[dict[str, Column]], keep: list[str] | None = None) -> DataFrame:
    """One output row per dict in ``rows`` for every input row; all dicts
    must have the same keys (the output columns) in the same order."""
    names = list(rows[0])
    structs = [F.struct(*[r[n].alias(n) for n in names]) for r in rows]
    keep = keep or []
    out = df.select(*keep, F.explode(F.array(*structs)).alias("__r"))
    return out.select(*keep, *[F.col(f"__r.{n}").alias(n) for n in names])
