"""Activity labels: a row is positive when its group is among the busiest.

Plan shape (one full scan of the rows for the counts, one for the join):

    rows --partial count--> shuffle(group) --> group table (one row per group)
    group table --exact percentile over sizes--> threshold (scalar subquery)
    rows ⋈ group table  (broadcast when the table's bytes are few,
                         hot groups taken apart otherwise; see joins.py)

The percentile runs over the group table, whose exact-percentile buffer holds
one entry per *distinct group size* -- bounded by sqrt(2 * rows) -- so the
exact answer is as cheap as an approximate one.  The reference gathered the
names of busy groups on the driver and inlined them as an ``isin`` list; the
join keeps everything on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.operators.joins import MAX_BROADCAST_BYTES, join_group_table, materialize

METHODS = ("element", "linear")


def group_sizes(df: DataFrame, group: str, count_col: str = "n") -> DataFrame:
    """One row per non-null group with its row count (map-side partial count,
    so a hot group costs one partial row per task before the shuffle)."""
    return (df.where(F.col(group).isNotNull())
              .groupBy(group).agg(F.count(F.lit(1)).alias(count_col)))


def threshold_expr(sizes: str, q: float, method: str) -> Column:
    """Aggregate expression for the q-quantile of group sizes.

    ``element``: the smallest size whose cumulative share reaches q (an
    element of the data, like approxQuantile at zero error);
    ``linear``: interpolated, rounded to 6 dp so float noise cannot flip ``>=``.
    """
    if method == "element":
        return F.expr(f"percentile_disc({float(q)!r}) within group (order by `{sizes}`)")
    if method == "linear":
        return F.round(F.percentile(F.col(sizes), F.lit(q)), 6)
    raise ValueError(f"method must be one of {METHODS}")


def activity_threshold(df: DataFrame, group: str, q: float = 0.8,
                       method: str = "element") -> DataFrame:
    """A one-row frame ``(threshold)`` over the group sizes of ``df``."""
    sizes = group_sizes(df, group)
    return sizes.agg(threshold_expr("n", q, method).cast("double").alias("threshold"))


def _activity_table(sizes: DataFrame, q: float, method: str, label_col: str) -> DataFrame:
    thr = sizes.agg(threshold_expr("n", q, method).cast("double")).scalar()
    return (sizes.withColumn("threshold", thr)
                 .withColumn(label_col, (F.col("n") >= F.col("threshold")).cast("int")))


def group_activity(df: DataFrame, group: str, q: float = 0.8, method: str = "element",
                   label_col: str = "is_active") -> DataFrame:
    """C8 table: ``(group, n, threshold, label)`` for every non-null group.

    The threshold is a scalar subquery over the same sizes, so the plan stays
    lazy and no value travels through Python.
    """
    return _activity_table(group_sizes(df, group), q, method, label_col)


def active_groups(df: DataFrame, group: str, q: float = 0.8, method: str = "element",
                  active: bool | None = None) -> DataFrame:
    """Groups above (``active=True``) / below (``False``) the threshold, or all."""
    t = group_activity(df, group, q, method)
    if active is None:
        return t
    return t.where(F.col("is_active") == (1 if active else 0))


def activity_label(df: DataFrame, group: str, q: float = 0.8, method: str = "element",
                   label_col: str = "is_active",
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                   keep_size: bool = False) -> DataFrame:
    """``df`` plus ``label_col`` = 1 when its group's size >= threshold.

    Rows with a null group, which never enter the group table, get 0.
    The group sizes are materialised once (checkpoint), so the size check,
    the threshold and the join all read the stored table instead of
    re-aggregating the rows.
    """
    sizes = materialize(group_sizes(df, group))        # the one full pass over the rows
    table = _activity_table(sizes, q, method, label_col)  # threshold from the stored sizes
    side = table.select(group, label_col, F.col("n").alias("__size"))
    joined = join_group_table(df, side, [group], how="left", max_broadcast_bytes=max_broadcast_bytes, size_col="__size")
    joined = joined.withColumn(label_col, F.coalesce(F.col(label_col), F.lit(0)))
    return joined.withColumnRenamed("__size", "n") if keep_size else joined.drop("__size")
