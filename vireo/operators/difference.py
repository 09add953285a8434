"""Difference of two tables by key: which keys were added, removed or changed.

Both tables are first reduced to a digest per hash range of the keys, an
aggregate of at most ``RANGES`` rows.  Only rows of ranges whose digests differ
are shuffled by key, so comparing a table with a slightly newer one moves little
more than what changed.

Keys compare null-safe.  Rows that share a key are compared as a multiset, so
repeated rows count and their order doesn't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.operators.clean import key_digest
from vireo.operators.joins import materialize

RANGES = 4096
_SUM = "decimal(38,0)"


def _digested(df: DataFrame, keys: list[str], cols: list[str], ranges: int) -> DataFrame:
    """Keys, their range, and 128 bits of the row's digest as two numbers, whose sums don't depend on the order of rows."""
    row = key_digest([*keys, *cols])
    half = lambda at: F.conv(F.substring(row, at, 15), 16, 10).cast("bigint")
    bucket = F.pmod(F.conv(F.substring(key_digest(keys), 1, 8), 16, 10).cast("bigint"), F.lit(ranges))
    return df.select(*keys, bucket.alias("__range"), half(1).alias("__x"), half(16).alias("__y"))


def _sums(side: str | None = None) -> list:
    """Rows and digest sums, of one side of a union where it is named."""
    at = (lambda c: c) if side is None else (lambda c: F.when(F.col("__side") == side, c))
    total = lambda c: F.coalesce(F.sum(at(c).cast(_SUM)), F.lit(0).cast(_SUM))
    name = side or ""
    return [total(F.lit(1)).alias(f"__n{name}"), total(F.col("__x")).alias(f"__x{name}"), total(F.col("__y")).alias(f"__y{name}")]


def _equal(names: tuple[str, ...] = ("__n", "__x", "__y")):
    out = F.lit(True)
    for n in names:
        out = out & (F.col(f"{n}a") == F.col(f"{n}b"))
    return out


def differing_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """The ranges of two digested tables that don't hold the same rows; at most as many rows as ranges."""
    per = lambda df, side: df.groupBy("__range").agg(*_sums()).withColumn("__side", F.lit(side))
    both = per(a, "a").unionByName(per(b, "b"))
    flat = [F.max(F.when(F.col("__side") == s, F.col(c))).alias(f"{c}{s}") for s in "ab" for c in ("__n", "__x", "__y")]
    same = F.coalesce(_equal(), F.lit(False))
    return both.groupBy("__range").agg(*flat).where(~same).select("__range")


def table_difference(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """``(keys..., status, rows_a, rows_b)`` of every key whose rows in ``a`` and ``b`` differ: added (only in ``b``), removed, changed.

    ``cols`` are the compared columns, by default all that both tables have.
    """
    cols = [c for c in a.columns if c in b.columns and c not in keys] if cols is None else list(cols)
    da, db = (_digested(t, keys, cols, ranges) for t in (a, b))
    differ = F.broadcast(materialize(differing_ranges(da, db)))  # at most ``ranges`` rows of one number
    rows = [t.join(differ, "__range", "left_semi").withColumn("__side", F.lit(s)) for s, t in (("a", da), ("b", db))]
    met = rows[0].unionByName(rows[1]).groupBy(*keys).agg(*_sums("a"), *_sums("b")).where(~_equal())
    status = F.when(F.col("__na") == 0, "added").when(F.col("__nb") == 0, "removed").otherwise("changed")
    return met.select(*keys, status.alias("status"), F.col("__na").cast("long").alias("rows_a"), F.col("__nb").cast("long").alias("rows_b"))
