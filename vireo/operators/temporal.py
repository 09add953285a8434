"""Joins and windows over time: as-of join, interval join, session windows.

What needs the rows before a row (as-of, sessions) is computed over range partitions of
(keys, time), as in ``cumulative``: a window inside each range, and for the keys that
cross a range bound, at most one at each bound, a carried value from the ranges before.
So a key with a third of all rows is cut by time and no task holds it.

The interval join deals both sides to time bins of a fixed width and joins inside the bins; a pair
is returned by the one bin in which its overlap starts, so nothing is found twice and
nothing is compared with everything.  Where only totals over a span's points are asked for, running
totals in time order give them without the pairs, whose number grows with the square of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.operators.cumulative import _RANGE, _ranged
from vireo.operators.joins import join_group_table, materialize


def _with_earlier(t: DataFrame, by: list[str], earlier: DataFrame) -> DataFrame:
    """``t`` with the carried columns of ``earlier`` (keys, range, ...), which has fewer rows than there are ranges."""
    names = {c: f"__e_{c}" for c in (*by, _RANGE)}
    side = earlier.select(*[F.col(c).alias(names[c]) for c in names], *[c for c in earlier.columns if c not in names])
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    return t.join(F.broadcast(side), on, "left").drop(*names.values())


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, take: list[str],
              strict: bool = False) -> DataFrame:
    """``left`` plus ``take`` of the latest ``right`` row of the same keys at or before (``strict``: before) its time.

    Of right rows with equal keys and time the largest by ``take`` counts.  Left rows with a null key or time,
    or with nothing before them, get nulls; right rows with a null key or time match nothing.
    """
    known = F.col(right_time).isNotNull()
    for k in on:
        known = known & F.col(k).isNotNull()
    row, got = F.struct(*[F.col(f"`{c}`") for c in left.columns]), F.struct(*take)
    asked = left.select(*on, F.col(left_time).alias("__at"), F.lit(0 if strict else 1).alias("__side"), row.alias("__row"))
    given = right.where(known).select(*on, F.col(right_time).alias("__at"), F.lit(1 if strict else 0).alias("__side"), got.alias("__got"))
    both = asked.unionByName(given, allowMissingColumns=True)
    t = _ranged(both, [*on, "__at", "__side", "__got"])
    inside = Window.partitionBy(*on, _RANGE).orderBy("__at", "__side", "__got").rowsBetween(Window.unboundedPreceding, 0)
    last = t.where("__got IS NOT NULL").groupBy(*on, _RANGE).agg(F.max(F.struct("__at", "__got")).alias("__last"))
    # a row for each range of a key, so that a range without a right row still learns of the ones before
    seen = t.groupBy(*on, _RANGE).agg(F.lit(1).alias("__one")).join(last, [*on, _RANGE], "left")
    before = Window.partitionBy(*on).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select(*on, _RANGE, F.last("__last", ignorenulls=True).over(before)["__got"].alias("__earlier")).where("__earlier IS NOT NULL")
    t = _with_earlier(t.withColumn("__inside", F.last("__got", ignorenulls=True).over(inside)), on, carried)
    found = F.when(F.col("__at").isNotNull(), F.coalesce("__inside", "__earlier"))
    return t.where(F.col("__row").isNotNull()).withColumn("__found", found).select("__row.*", *[F.col(f"__found.{c}").alias(c) for c in take])


def _bin(micros: Column, width: int) -> Column:
    return F.floor(micros / F.lit(width * 1_000_000)).cast("long")


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str] | str, bin_seconds: int,
                  on: list[str] | None = None, totals_of: str | None = None) -> DataFrame:
    """All pairs of rows (of equal keys ``on``) whose half-open spans overlap; ``right_span`` may be a single time column, a point.

    With ``totals_of``, a column of points, the left rows that have a pair come back once, with the number of their pairs and the
    column's smallest and largest value in them, and the pairs are never made: see ``interval_totals``.

    Columns of both sides must differ but for ``on``.  Rows with a null bound or an empty span match nothing.
    ``bin_seconds`` of about the usual span keeps both the copies of a row and the pairs compared few.
    """
    on = on or []
    width = bin_seconds * 1_000_000
    point = isinstance(right_span, str)
    if totals_of is not None:
        if not point:
            raise ValueError("totals are of points")
        return interval_totals(left, right, left_span, right_span, totals_of, on)
    spans = {"l": left_span, "r": (right_span, right_span) if point else right_span}

    def dealt(df: DataFrame, side: str) -> DataFrame:
        low, high = (F.unix_micros(F.col(c).cast("timestamp")) for c in spans[side])
        df = df.withColumn(f"__{side}0", low).withColumn(f"__{side}1", high + 1 if side == "r" and point else high)
        df = df.where(F.col(f"__{side}0") < F.col(f"__{side}1"))
        bins = F.sequence(F.floor(F.col(f"__{side}0") / width).cast("long"), F.floor((F.col(f"__{side}1") - 1) / width).cast("long"))
        return df.withColumn("__bin", F.explode(bins))

    a, b = dealt(left, "l"), dealt(right, "r")
    owner = F.floor(F.greatest("__l0", "__r0") / width).cast("long")
    met = a.join(b, [*on, "__bin"]).where((F.col("__l0") < F.col("__r1")) & (F.col("__r0") < F.col("__l1")) & (F.col("__bin") == owner))
    return met.drop("__bin", "__l0", "__l1", "__r0", "__r1")


def _widths(spans: DataFrame) -> DataFrame:
    """``spans`` plus ``__width``: the power of two at or below the span's length."""
    length = F.col("__l1") - F.col("__l0")
    return spans.withColumn("__width", F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(length)) - 1))


def interval_totals(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_time: str, value: str,
                    on: list[str] | None = None) -> DataFrame:
    """``left`` rows that meet points of ``right`` (as in ``interval_join``) plus ``n``, ``least`` and ``most``: how many
    points each meets, and the smallest and largest ``value`` of them.

    No pair is made, so the work grows with the rows, not with how many points a span holds.  For spans whose
    length is from w to below 2 w (w a power of two), time is cut into bins of w: such a span is the end of a bin, at most one
    whole bin and the start of a bin.  Points and the spans' bounds are put in order inside their bins, forwards
    and backwards, and a running count, minimum and maximum answers each bound.  There are fewer than 64 widths.
    """
    on = on or []
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = left.withColumn("__l0", micros(left_span[0])).withColumn("__l1", micros(left_span[1])).where(known & (F.col("__l0") < F.col("__l1")))
    spans = materialize(_widths(rows.groupBy(*on, "__l0", "__l1").agg(F.count(F.lit(1)).alias("__rows"))))
    widths = F.broadcast(spans.select("__width").distinct())  # fewer than 64
    w = F.col("__width")
    bin_of = lambda at: F.expr(f"({at} - pmod({at}, __width)) div __width")
    first, last = bin_of("__l0"), bin_of("(__l1 - 1)")

    def probe(bin_, back, at, when):
        return F.when(when, F.struct(bin_.alias("__bin"), back.alias("__back"), at.alias("__at")))

    # a bound asks for what comes before it in its direction; backwards a point at the bound itself counts
    middle = first + 1
    asked = F.array(probe(first, F.lit(True), 1 - F.col("__l0"), F.lit(True)), probe(last, F.lit(False), F.col("__l1"), last > first),
                    probe(middle, F.lit(True), 1 - middle * w, last - first == 2))
    bounds = spans.withColumn("__p", F.explode(F.filter(asked, lambda p: p.isNotNull()))).select(*on, "__width", "__p.*", "__l0", "__l1", F.lit(False).alias("__point"))
    at = right.where(known & F.col(right_time).isNotNull()).select(*on, micros(right_time).alias("__t"), F.col(value).alias("__v")).crossJoin(widths)
    both_ways = F.explode(F.array(F.lit(False), F.lit(True))).alias("__back")
    points = at.select(*on, "__width", bin_of("__t").alias("__bin"), both_ways, "__t", "__v")
    points = points.select(*on, "__width", "__bin", "__back", F.when(F.col("__back"), -F.col("__t")).otherwise(F.col("__t")).alias("__at"), "__v", F.lit(True).alias("__point"))
    by = [*on, "__width", "__bin", "__back"]
    t = _ranged(bounds.unionByName(points, allowMissingColumns=True), [*by, "__at", "__point"])
    inside = Window.partitionBy(*by, _RANGE).orderBy("__at", "__point").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    one = F.col("__point").cast("long")
    ends = t.groupBy(*by, _RANGE).agg(F.sum(one).alias("__n"), F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    carried = ends.select(*by, _RANGE, F.sum("__n").over(before).alias("__en"), F.min("__a").over(before).alias("__ea"), F.max("__b").over(before).alias("__eb")).where("__en > 0")
    t = t.select("*", F.sum(one).over(inside).alias("__n"), F.min("__v").over(inside).alias("__a"), F.max("__v").over(inside).alias("__b"))
    t = _with_earlier(t.where(~F.col("__point")), by, carried)
    met = t.groupBy(*on, "__l0", "__l1").agg(F.sum(F.col("__n") + F.coalesce("__en", F.lit(0))).alias("n"),
                                            F.min(F.least("__a", "__ea")).alias("least"), F.max(F.greatest("__b", "__eb")).alias("most"))
    met = materialize(met.where("n > 0").join(spans.select(*on, "__l0", "__l1", "__rows"), [*on, "__l0", "__l1"]))
    return join_group_table(rows, met, [*on, "__l0", "__l1"], "inner", size_col="__rows").select(*left.columns, "n", "least", "most")


def session_windows(df: DataFrame, by: list[str], time_col: str, gap_seconds: int) -> DataFrame:
    """(by..., session_start, session_end, n): runs of rows in which no row is ``gap_seconds`` or more after the one before.

    ``session_end`` is the last row's time plus the gap, as in ``session_window``; rows without a time are left out.
    """
    t = _ranged(df.where(F.col(time_col).isNotNull()).select(*by, F.col(time_col).alias("__at")), [*by, "__at"])
    inside = Window.partitionBy(*by, _RANGE).orderBy("__at")
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ends = t.groupBy(*by, _RANGE).agg(F.max("__at").alias("__end"))
    carried = ends.select(*by, _RANGE, F.max("__end").over(before).alias("__earlier")).where("__earlier IS NOT NULL")
    t = _with_earlier(t.withColumn("__inside", F.lag("__at").over(inside)), by, carried)
    previous = F.coalesce("__inside", "__earlier")
    apart = F.unix_micros(F.col("__at").cast("timestamp")) - F.unix_micros(previous.cast("timestamp"))
    t = t.withColumn("__new", F.when(previous.isNull() | (apart >= gap_seconds * 1_000_000), 1).otherwise(0)).drop("__inside", "__earlier")
    # sessions are numbered inside a range; its first run goes on with the last session of the ranges before where it isn't new
    t = t.withColumn("__nth", F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = t.groupBy(*by, _RANGE, "__nth").agg(F.min("__at").alias("__first"), F.max("__at").alias("__last"), F.count("*").alias("__n"), F.max("__new").alias("__new"))
    opened = runs.groupBy(*by, _RANGE).agg(F.sum("__new").alias("__opened"))
    offsets = opened.select(*by, _RANGE, F.sum("__opened").over(before).alias("__offset")).where("__offset IS NOT NULL")
    runs = _with_earlier(runs, by, offsets).withColumn("__session", F.col("__nth") + F.coalesce("__offset", F.lit(0)))
    out = runs.groupBy(*by, "__session").agg(F.min("__first").alias("session_start"), F.max("__last").alias("__last"), F.sum("__n").alias("n"))
    return out.select(*by, "session_start", (F.col("__last") + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("session_end"), "n")
