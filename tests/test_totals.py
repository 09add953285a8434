"""Totals over a span's points equal those of the pairs, without the pairs."""

import random

import pytest
from pyspark.sql import functions as F

from vireo.operators import temporal


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("keyed", [False, True])
def test_totals_equal_the_pairs(spark, keyed):
    r = random.Random(5)
    moment = lambda s: None if s is None else f"2024-01-01 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"
    some = lambda: None if r.random() < 0.05 else r.randrange(6000)
    spans = [(i % 7, i % 3, x, None if x is None else x + r.choice([-1, 0, 1, 2, 60, 64, 1023, 4096])) for i in range(300) for x in [some()]]
    left = spark.createDataFrame([(i, k, moment(a), moment(b and max(b, 0))) for i, k, a, b in spans], "id long, k long, a string, b string")
    left = left.withColumn("a", F.col("a").cast("timestamp")).withColumn("b", F.col("b").cast("timestamp"))
    right = spark.createDataFrame([(i % 3 if i % 11 else None, moment(some()), None if i % 9 == 0 else i) for i in range(900)], "k long, t string, e long")
    right = right.withColumn("t", F.col("t").cast("timestamp"))
    left, right, on = (left, right, ["k"]) if keyed else (left.drop("k"), right.drop("k"), None)
    args = ("a", "b"), "t", 64, on
    total = [F.sum("n"), F.min("least"), F.max("most")]
    got = temporal.interval_join(left, right, *args, totals_of="e")
    pairs = temporal.interval_join(left, right, *args)
    want = pairs.groupBy("id").agg(F.count(F.lit(1)), F.min("e"), F.max("e"))
    assert rows(got.groupBy("id").agg(*total).toDF(*"inab")) == rows(want.toDF(*"inab"))
    assert 0 < got.count() < left.count()
    with pytest.raises(ValueError):
        temporal.interval_join(left, right, ("a", "b"), ("t", "t"), 64, on, totals_of="e")


def test_totals_make_no_pairs(spark):
    """10,000 different windows over 10,000 points: 100 million pairs."""
    at = lambda c: F.timestamp_micros(c)
    left = spark.range(10_000).select("id", at(F.col("id")).alias("a"), at(F.col("id") + 30_000).alias("b"))
    right = spark.range(10_000).select(F.col("id").alias("e"), at(F.col("id") + 10_000).alias("t"))
    out = temporal.interval_join(left, right, ("a", "b"), "t", 1, totals_of="e")
    assert out.agg(F.sum("n"), F.min("least"), F.max("most")).first() == (100_000_000, 0, 9999)
    joined = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined and "Generate" not in joined
