"""Planted-signal model fits, save/load, CSV and plan properties."""

import os
import tempfile

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vireo.operators import evaluation as ev
from vireo.operators import models as md
from vireo.operators import vectors as vec
from vireo.sources import files
from vireo.sources.models import load_pipeline, save_model


@pytest.fixture(scope="module")
def planted(spark):
    """Label 1 rows contain the token 'zebra'; label 0 rows do not."""
    rows = []
    for i in range(400):
        y = i % 2
        words = " ".join(f"w{(i * 7 + k) % 50}" for k in range(12))
        rows.append((i, y, (words + " zebra zebra") if y else words, "en"))
    return spark.createDataFrame(rows, "id long, y int, text string, group string") \
                .withColumn("summary", F.substring_index("text", " ", 3))


def test_planted_signal_lr(planted):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=256, min_doc_freq=1)
    _, train, test = md.prepare(planted, pipe, "id", "y")
    fitted, metrics = md.train_all(train, test, {"lr": md.logistic(max_iter=30)})
    assert metrics.first()["auc"] > 0.95


def test_shuffled_labels_near_chance(planted):
    shuffled = planted.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("int"))
    pipe = vec.build_pipeline("text", "summary", "group", num_features=256, min_doc_freq=1)
    _, train, test = md.prepare(shuffled, pipe, "id", "y")
    m = md.logistic(max_iter=30).fit(train)
    auc = ev.auc_roc(md.score(m, test)).first()[0]
    assert 0.25 < auc < 0.75


def test_tree_importances_sum_to_one(planted):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=128, min_doc_freq=1, include_group=True)
    _, train, _ = md.prepare(planted, pipe, "id", "y")
    rf = md.random_forest(num_trees=10, max_depth=4).fit(train)
    assert sum(rf.featureImportances.toArray()) == pytest.approx(1.0)
    top = md.feature_importance(rf, md.slot_names(train), k=5).collect()
    assert len(top) <= 5


def test_pipeline_save_load_equal(spark, planted):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=64, min_doc_freq=1)
    model = pipe.fit(planted)
    path = os.path.join(tempfile.mkdtemp(prefix="vireo-model-"), "pipe")
    save_model(model, path)
    again = load_pipeline(path)
    a = model.transform(planted).select("id", vector_to_array("features").alias("f")).orderBy("id").collect()
    b = again.transform(planted).select("id", vector_to_array("features").alias("f")).orderBy("id").collect()
    assert a == b


def test_csv_roundtrip_with_newlines_and_quotes(spark):
    rows = [(1, 'He said "hi"\nthen left', " lead", "x"), (2, "", None, "y,z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    path = os.path.join(tempfile.mkdtemp(prefix="vireo-csv-"), "t")
    files.write_csv(df, path)
    back = files.read_posts_csv(spark, path, df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)  # '' and null stay apart


def test_mart_writes_as_many_files_as_rows_need(spark):
    path = os.path.join(tempfile.mkdtemp(), "m")
    files.write_mart(spark.range(10), path, rows_per_file=4)
    assert files.read_mart(spark, path, "id bigint").count() == 10
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 3


def test_partition_filter_and_pushdown_in_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = os.path.join(tempfile.mkdtemp(prefix="vireo-part-"), "p")
    files.write_partitioned(docs, path, "lang")
    plan = files.read_partition(spark, path, F.col("lang") == "en")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lang" in plan
    scan = docs.where(F.col("n_chars") > 100).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n_chars), GreaterThan(n_chars,100)]" in scan
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in scan


def test_write_predictions_roundtrip(spark, planted):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=64, min_doc_freq=1)
    _, train, test = md.prepare(planted, pipe, "id", "y")
    pred = md.logistic(max_iter=10).fit(train).transform(test)
    path = os.path.join(tempfile.mkdtemp(prefix="vireo-pred-"), "p")
    files.write_predictions(pred.withColumnRenamed("id", "doc_id"), path)
    back = spark.read.parquet(path)
    assert set(back.columns) == {"doc_id", "label", "prediction", "probability", "rawPrediction"}
    assert back.count() == test.count()


def test_inferred_csv_counts_bad_rows(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="vireo-bad-"), "t.csv")
    with open(path, "w") as f:
        f.write("id,score\n1,2.5\n2,3.5\n3,oops\n")
    df = files.read_csv_inferred(spark, path, multi_line=False)
    # the first pass infers score as string because of the bad value; with a
    # numeric schema the bad line is caught
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("score", T.DoubleType()),
                           T.StructField("_corrupt_record", T.StringType())])
    strict = (spark.read.option("header", True).schema(schema).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    counts = files.bad_row_count(strict).first()
    assert (counts["rows"], counts["bad_rows"]) == (3, 1)
    assert "_corrupt_record" in df.columns and df.count() == 3


def test_fit_pipeline_equals_pipeline_fit(planted):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=64, min_doc_freq=1, include_group=True)
    a = pipe.fit(planted).transform(planted).select("id", vector_to_array("features").alias("f"))
    b = md.fit_pipeline(pipe, planted).transform(planted).select("id", vector_to_array("features").alias("f"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_boosting_prefixes_equal_full_fits(spark):
    """One long fit scored at a shorter length is the shorter fit; the tuned table equals cross-validation."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import functions as F

    from vireo.operators import models as md

    x = [F.rand(i) for i in range(4)]
    df = spark.range(300).select("id", F.array(*x).alias("x")).select("id", array_to_vector("x").alias("features"), (F.col("x")[0] + F.col("x")[1] * F.col("x")[2] > 0.8).cast("double").alias("label"))
    df = df.cache()
    long, short = md.gbt(6, 3).fit(df), md.gbt(3, 3).fit(df)
    raw = lambda m: [r[0] for r in m.transform(df).orderBy("id").select(vector_to_array("rawPrediction")[1]).collect()]
    assert raw(md.boosting_prefix(long, 3)) == raw(short) != raw(long)
    grid = {"maxIter": [2, 4], "maxDepth": [2, 3], "stepSize": [0.1]}
    mine = {r["params"]: round(r["mean_auc"], 9) for r in md.tune_boosting(grid, df, "id", folds=2).collect()}
    plain = {r["params"]: round(r["mean_auc"], 9) for r in md.cv_table(md.tune(md.gbt(), grid, df, "id", folds=2)).collect()}
    assert mine == plain and len(mine) == 4
    df.unpersist()
