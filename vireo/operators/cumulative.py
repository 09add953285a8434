"""Running sums, ranks and exact quantiles without a single-partition window.

A global ``Window.orderBy(x)`` moves every row into one task.  Instead the rows
are range-partitioned on the order (as many ranges as there are shuffle
partitions, so the work spreads with the cluster), stored, summed per range, and
the ranges' totals become offsets by a window over one row per range (and
group).  A window inside each range finishes the job.  Everything is exact; the
range bounds only balance the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.operators.joins import materialize

_RANGE = "__range"


def _ranged(df: DataFrame, orders: list) -> DataFrame:
    """``df`` range-partitioned on ``orders`` with the range's number; stored, as both later reads need the same ranges."""
    return materialize(df.repartitionByRange(*orders).withColumn(_RANGE, F.spark_partition_id()))


def below_sums(table: DataFrame, order: str, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """``table`` (one row per group ``by`` and ``order``) plus ``below_<c>``: the sum of ``c`` over the
    group's rows with a strictly smaller ``order``."""
    by = by or []
    t = _ranged(table, [*by, order])
    totals = t.groupBy(*by, _RANGE).agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__k_{c}") for c in (*by, _RANGE)],
                            *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in cols])
    on = F.lit(True)
    for c in (*by, _RANGE):
        on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    inside = Window.partitionBy(*by, _RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return t.join(offsets, on).select(*table.columns, *[
        (F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"below_{c}") for c in cols])


def row_numbers(df: DataFrame, orders: list[Column], out: str) -> DataFrame:
    """``df`` plus its row number from 1 in the order of ``orders``."""
    t = _ranged(df, orders)
    sizes = t.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    offsets = sizes.select(_RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    local = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*orders))
    return t.join(offsets, _RANGE).select(*df.columns, (F.col("__o") + local).alias(out))


def exact_quantiles(rows: DataFrame, col: str, probs: list[float], by: list[str] | None = None,
                    linear: bool = False) -> DataFrame:
    """``(by..., n, q)``: exact quantiles of the non-null values of ``col`` per group, as an array.

    ``linear`` interpolates between neighbours (pandas); otherwise a quantile is the smallest value whose
    cumulative share reaches the probability.  The values meet as one row per distinct value, ranked by
    ``below_sums``, so no task holds all values of a group.
    """
    by = by or []
    x = F.col(col).cast("double")
    counts = materialize(rows.where(x.isNotNull()).groupBy(*by, x.alias("__x")).agg(F.count(F.lit(1)).alias("__n")))
    ranked = below_sums(counts, "__x", ["__n"], by)
    sizes = counts.groupBy(*[F.col(c).alias(f"__g_{c}") for c in by]).agg(F.sum("__n").alias("n"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    t = ranked.join(sizes, on) if by else ranked.crossJoin(sizes)  # sizes: one row per group

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("below___n") <= position) & (position < F.col("below___n") + F.col("__n")), F.col("__x")))

    quantiles = []
    for p in probs:
        if linear:
            place = F.lit(float(p)) * (F.col("n") - 1)
            low, high = at(F.floor(place)), at(F.ceil(place))
            part = F.max(place - F.floor(place))
            quantiles.append(low + (high - low) * part)
        else:
            quantiles.append(at(F.greatest(F.ceil(F.lit(float(p)) * F.col("n")) - 1, F.lit(0))))
    return t.groupBy(*by).agg(F.max("n").alias("n"), F.array(*quantiles).alias("q"))
