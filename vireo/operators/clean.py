"""Cleaning: drop missing, deterministic dedup, fills, length filters, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(subset=cols)


def dedup(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """One row per ``keys`` -- the one with the smallest ``order_by``, of equal ones the smallest by all other columns.

    One read and one shuffle of the rows, by a digest of the keys; every map task keeps one row a key,
    so a text with a third of all rows costs a row per task.  Maps have no order and don't decide.
    """
    others = [f.name for f in df.schema.fields if f.name not in (*keys, order_by) and "map<" not in f.dataType.simpleString()]
    row, order = F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[F.col(f"`{c}`") for c in (order_by, *others)])
    return df.groupBy(key_digest(keys).alias("__key")).agg(F.min_by(row, order).alias("__row")).select("__row.*")


def key_digest(keys: list[str]):
    """A 256-bit digest of key columns that tells null from any value and keeps values apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)


def fill_text(df: DataFrame, cols: list[str], value: str = "") -> DataFrame:
    """Null text -> ``value`` in one projection."""
    cs = set(cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in cs else F.col(c)
                       for c in df.columns])


def fill_numeric(df: DataFrame, cols: list[str], value: float = 0.0) -> DataFrame:
    """C4: null numeric -> ``value`` (as double) in one projection."""
    cs = set(cols)
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float(value))).alias(c) if c in cs
                       else F.col(c) for c in df.columns])


def min_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Keep rows with ``length(col) > n`` for every entry (nulls fail)."""
    cond = F.lit(True)
    for c, n in limits.items():
        cond = cond & (F.length(F.col(c)) > n)
    return df.where(cond)


def as_label(df: DataFrame, col: str, features: list[str] | None = None) -> DataFrame:
    """``col`` renamed to ``label`` as double; rows with a null label or
    null feature dropped."""
    out = df.withColumn(col, F.col(col).cast("double")).withColumnRenamed(col, "label")
    return out.dropna(subset=["label"] + list(features or []))
