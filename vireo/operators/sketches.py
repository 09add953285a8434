"""Mergeable profile state: per-day counts, distinct and quantile sketches that are stored and merged without the rows.

A day's state is a row of numbers and binaries (HyperLogLog for distinct values, KLL for quantiles).  States of any
days merge into the state of all of them, so a profile over a year reads 365 rows a group, not
the year's rows; and a late day only needs its own state made again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of HyperLogLog registers (relative standard error about 0.8 / 2^(lg/2)), and KLL's k (rank error about 1.7 / k at 99 %).
LG_REGISTERS, KLL_K = 14, 800


def profile_state(df: DataFrame, by: list[str], distinct: list[str], numeric: list[str]) -> DataFrame:
    """One state row per ``by``: rows, and for the columns named their sketches, non-null counts, sums and ranges."""
    cells = [F.count(F.lit(1)).alias("rows")]
    for c in distinct:
        cells.append(F.hll_sketch_agg(F.col(c), F.lit(LG_REGISTERS)).alias(f"{c}_hll"))
    for c in numeric:
        x = F.col(c).cast("double")
        cells += [F.count(x).alias(f"{c}_n"), F.sum(x).alias(f"{c}_sum"), F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max"),
                  F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"{c}_kll")]
    return df.groupBy(*by).agg(*cells)


def merge_states(states: DataFrame, by: list[str]) -> DataFrame:
    """States merged to ``by`` (none: one row), in the same layout."""
    cells = []
    for c in states.columns:
        if c in by:
            continue
        if c.endswith("_hll"):
            cells.append(F.hll_union_agg(c).alias(c))
        elif c.endswith("_kll"):
            cells.append(F.kll_merge_agg_double(F.col(c), F.lit(KLL_K)).alias(c))
        elif c == "rows" or c.endswith(("_n", "_sum")):
            cells.append(F.sum(c).alias(c))
        elif c.endswith("_min"):
            cells.append(F.min(c).alias(c))
        elif c.endswith("_max"):
            cells.append(F.max(c).alias(c))
    return states.groupBy(*by).agg(*cells)


def read_state(states: DataFrame, probs: list[float]) -> DataFrame:
    """States as figures: ``<c>_distinct`` for each HyperLogLog, ``<c>_q`` (array) for each KLL, all else as it is."""
    cells = []
    for c in states.columns:
        if c.endswith("_hll"):
            cells.append(F.hll_sketch_estimate(c).alias(f"{c[:-4]}_distinct"))
        elif c.endswith("_kll"):
            cells.append(F.array(*[F.kll_sketch_get_quantile_double(F.col(c), F.lit(p)) for p in probs]).alias(f"{c[:-4]}_q"))
        else:
            cells.append(F.col(c))
    return states.select(*cells)
