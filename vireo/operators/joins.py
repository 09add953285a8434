"""Joining a per-group table back onto the rows it was aggregated from.

The group table has one row per key, so its size is the number of groups,
not the number of rows -- but that can still be large, keys may be long, and one
key (or the null key) may hold a third of all rows.  Strategy:

* the group table is stored once; its bytes are summed, and it is broadcast
  only if they are within ``max_broadcast_bytes``;
* otherwise, when the table carries each key's row count (``size_col``), keys with
  more than ``hot_rows`` rows are taken apart: there are at most total / hot_rows of
  them, so with the default threshold their table rows are bounded by 4 x parallelism
  and broadcast, and the hot rows aren't shuffled at all.  All other keys join by a
  shuffle.  Rows with a null key match nothing and stay where they are.  Which way a
  row goes depends on its key alone, so a task that runs again returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.session import cut_lineage

MAX_BROADCAST_BYTES = 64 << 20
HOT_SHARE_DIVISOR = 4


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint a small derived table so it is computed once and survives
    executor loss; later reads (count, join, subqueries) reuse it."""
    return cut_lineage(df, eager=True)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text by its length, arrays, maps and structs by their JSON, 16 for anything else."""
    def one(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith(("array<", "map<", "struct<")):
            c = F.to_json(F.struct(c))
        elif kind not in ("string", "binary"):
            return F.lit(16)
        return F.coalesce(F.octet_length(c), F.lit(0))
    return sum((one(n, t) for n, t in df.dtypes), F.lit(16)).cast("long")


def table_bytes(table: DataFrame) -> int:
    """Bytes of a stored table's values: text by its length, 16 for anything else."""
    sizes = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) if t in ("string", "binary") else F.lit(16) for c, t in table.dtypes]
    return table.agg(F.sum(sum(sizes[1:], sizes[0]).cast("long") + 16)).first()[0] or 0


def join_group_table(big: DataFrame, table: DataFrame, keys: list[str], how: str = "left",
                     max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                     size_col: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """``big ⋈ table`` on ``keys`` where ``table`` is stored and unique on ``keys``.

    ``size_col`` names the column of ``table`` holding each key's row count
    in ``big``; it stays in the output.  Without it, skew is left to adaptive execution.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins keep the big side whole")
    if table_bytes(table) <= max_broadcast_bytes:
        return big.join(F.broadcast(table), on=keys, how=how)
    if size_col is None:
        return big.join(table, on=keys, how=how)
    parallelism = big.sparkSession.sparkContext.defaultParallelism
    if hot_rows is None:
        total = table.agg(F.sum(size_col)).first()[0] or 0
        hot_rows = max(1, total // (HOT_SHARE_DIVISOR * parallelism))
    # at most total / hot_rows rows, so their broadcast is bounded; hot rows stay where they are
    hot = F.broadcast(table.where(F.col(size_col) > hot_rows))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    cold = big.where(~missing).join(F.broadcast(hot.select(*keys)), on=keys, how="left_anti")
    columns = [*big.columns, *[c for c in table.columns if c not in keys]]
    out = cold.join(table.where(F.col(size_col) <= hot_rows), on=keys, how=how).select(*columns).unionByName(big.join(hot, on=keys, how="inner").select(*columns))
    if how == "inner":
        return out
    # rows with a null key match nothing and need no shuffle
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields if f.name not in keys]
    return out.unionByName(big.where(missing).select("*", *added)).select(*columns)
