"""Bucketed tables: rows laid out by key once, so later grouping, dedup and joins on the key need no shuffle.

A key with more rows or bytes than a bucket is meant to hold (the null key too) would make one bucket, and one task, as large
as itself.  Such hot keys are written apart, unbucketed, under ``hot``; there are fewer of them than buckets.  All
other rows are hash-bucketed and sorted by the key under ``cold``, one file a bucket.  A bucket is one task's work, so
it is sized by rows and by bytes: wide rows make more buckets.  As a key is in one part only,
a keyed operator runs on both parts and its results are put together: without an exchange on the cold part, with
the usual pre-aggregation or size-checked join on the hot one.

Tables written together share bucket count and hot keys, which is what a join without a shuffle needs.  The layout is
stored beside the rows, so another session opens the tables by path.  An empty table has one bucket;
rows keep all their columns; repeated rows stay.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vireo.operators.joins import MAX_BROADCAST_BYTES, materialize, row_bytes, table_bytes

ROWS_PER_BUCKET = 1_000_000
BYTES_PER_BUCKET = 64 << 20


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts that share no key."""
    cold: DataFrame
    hot: DataFrame
    keys: list[str]
    buckets: int

    def each(self, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``operator`` on both parts; right for whatever treats keys apart."""
        return operator(self.cold).unionByName(operator(self.hot))

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)


def write_bucketed(tables: dict[str, DataFrame], path: str, by: list[str], rows_per_bucket: int = ROWS_PER_BUCKET,
                   bytes_per_bucket: int = BYTES_PER_BUCKET) -> dict[str, Bucketed]:
    """Write ``tables`` (by name) under ``path`` in one layout on the key columns ``by``, and open them.

    Keys are counted first (pre-aggregated, without the other columns); the largest table sets the number of
    buckets, and a key that is hot in one table is hot in all.
    """
    spark = next(iter(tables.values())).sparkSession
    counted = None
    for name, df in tables.items():
        part = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"), F.sum(row_bytes(df)).alias("__bytes")).withColumn("__table", F.lit(name))
        counted = part if counted is None else counted.unionByName(part)
    counted = materialize(counted)
    totals = counted.groupBy("__table").agg(F.sum("__rows").alias("n"), F.sum("__bytes").alias("b")).collect()  # a row per table
    buckets = max([max(-(-r["n"] // rows_per_bucket), -(-r["b"] // bytes_per_bucket)) for r in totals], default=1)
    # fewer than total / rows_per_bucket + bytes / bytes_per_bucket keys of each table
    hot_keys = materialize(counted.where((F.col("__rows") > rows_per_bucket) | (F.col("__bytes") > bytes_per_bucket)).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]).distinct())
    listed = F.broadcast(hot_keys) if table_bytes(hot_keys) <= MAX_BROADCAST_BYTES else hot_keys
    for name, df in tables.items():
        same = F.lit(True)
        for i, k in enumerate(by):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        df.join(listed, same, "left_semi").write.mode("overwrite").parquet(f"{path}/{name}/hot")
        (df.join(listed, same, "left_anti").repartition(buckets, *by).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *by).sortBy(*by).option("path", f"{path}/{name}/cold").saveAsTable(_name()))
    spark.createDataFrame([(buckets, by, name, df.schema.json()) for name, df in tables.items()],
                          "buckets int, keys array<string>, name string, schema string").coalesce(1).write.mode("overwrite").json(f"{path}/layout")
    return open_bucketed(spark, path)


def open_bucketed(spark: SparkSession, path: str) -> dict[str, Bucketed]:
    """The tables under ``path``, by name, in this session."""
    out = {}
    for r in spark.read.schema("buckets int, keys array<string>, name string, schema string").json(f"{path}/layout").collect():  # a row per table
        schema = StructType.fromJson(json.loads(r["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys, table, at = ", ".join(f"`{k}`" for k in r["keys"]), _name(), f"{path}/{r['name']}"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {r['buckets']} BUCKETS LOCATION '{at}/cold'")
        out[r["name"]] = Bucketed(spark.table(table), spark.read.schema(schema).parquet(f"{at}/hot"), list(r["keys"]), r["buckets"])
    return out


def _name() -> str:
    return f"vireo_bucketed_{uuid.uuid4().hex}"


def group_sizes(table: Bucketed, size: str = "n") -> DataFrame:
    """One row per key with its number of rows."""
    return table.each(lambda part: part.groupBy(*table.keys).agg(F.count(F.lit(1)).alias(size)))


def first_rows(table: Bucketed, order_by: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_by``, of equal ones the smallest by all other columns (maps don't decide)."""
    names = table.cold.columns
    others = [f.name for f in table.cold.schema.fields if f.name not in (*table.keys, order_by) and "map<" not in f.dataType.simpleString()]
    row, order = (F.struct(*[F.col(f"`{c}`") for c in cols]) for cols in (names, (order_by, *others)))
    return table.each(lambda part: part.groupBy(*table.keys).agg(F.min_by(row, order).alias("__row")).select("__row.*"))


def join_bucketed(left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """``left ⋈ right`` on their keys, for tables written together; cold buckets meet where they are.

    The hot parts have few keys, each with many rows on one side at least: adaptive execution broadcasts the small
    side or splits the key.
    """
    if (left.keys, left.buckets) != (right.keys, right.buckets):
        raise ValueError("only tables written together can be joined by bucket")
    return left.cold.hint("merge").join(right.cold, left.keys, how).unionByName(left.hot.join(right.hot, left.keys, how))
