"""Hash sampling and splitting: reproducible, disjoint, complete, exact per class."""

import math

from pyspark.sql import functions as F

from conftest import SF_CHECK
from vireo.operators import sampling as smp


def test_split_disjoint_and_complete(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id")
    a, b = smp.split(d, "doc_id", [0.8, 0.2])
    ids_a = {r[0] for r in a.collect()}
    ids_b = {r[0] for r in b.collect()}
    assert not ids_a & ids_b
    assert len(ids_a | ids_b) == d.count()


def test_split_independent_of_partitioning(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id")
    a1 = {r[0] for r in smp.split(d, "doc_id", [0.8, 0.2])[1].collect()}
    a2 = {r[0] for r in smp.split(d.repartition(7), "doc_id", [0.8, 0.2])[1].collect()}
    assert a1 == a2


def test_stratified_split_exact(spark):
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = smp.stratified_split(lab, "quality", "doc_id", 0.2)
    per = {r["quality"]: (r["n"], r["t"]) for r in
           out.groupBy("quality").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    for n, t in per.values():
        assert t == math.ceil(0.2 * n)


def test_nested_fractions_are_nested(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = sorted((r["fraction"], r["rows"]) for r in smp.nested_fractions(d, "doc_id", [0.1, 0.5, 1.0]).collect())
    assert rows[0][1] <= rows[1][1] <= rows[2][1] == d.count()
    small = {r[0] for r in smp.hash_sample(d, "doc_id", 0.1).select("doc_id").collect()}
    big = {r[0] for r in smp.hash_sample(d, "doc_id", 0.5).select("doc_id").collect()}
    assert small <= big


def test_fold_column_range(spark):
    d = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    folds = {r[0] for r in d.select(smp.fold_column("doc_id", 3)).distinct().collect()}
    assert folds == {0, 1, 2}
