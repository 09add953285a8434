"""Skew, nulls and long rows: what the plain test tables cannot show."""

import glob
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from vireo.functions.hashing import key_hash64, poisson1_cdf, poisson1_weight, with_stream_uniform
from vireo.operators import clean, cumulative, evaluation, features, joins, label, models, profile, sampling, vectors
from vireo.session import ensure_checkpoint_dir
from vireo.sources import files


@pytest.fixture()
def plain_joins(spark):
    """Shuffle joins with as many tasks as asked for."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_per_task(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_null_keys_are_spread(spark, plain_joins):
    df = spark.range(2000).select(F.when(F.col("id") >= 1900, F.concat(F.lit("g"), F.col("id") % 5)).alias("grp"))
    out = label.activity_label(df, "grp", max_broadcast_bytes=0)
    assert out.count() == 2000 and out.where("grp IS NULL AND is_active <> 0").count() == 0
    assert max(rows_per_task(out)) < 700


def test_hot_key_of_a_one_column_frame_is_split(spark, plain_joins):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("grp"))
    sizes = joins.materialize(label.group_sizes(df, "grp"))
    out = joins.join_group_table(df, sizes, ["grp"], "left", max_broadcast_bytes=0, size_col="n", hot_rows=200)
    assert out.count() == 4000 and out.where("n IS NULL").count() == 0
    assert max(rows_per_task(out)) < 1500


def test_partitioned_write_follows_the_rows(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(None).cast("int").alias("y"))
    path = os.path.join(tempfile.mkdtemp(), "t")
    files.write_partitioned(df, path, "y", rows_per_file=100)
    assert len(glob.glob(f"{path}/y=1/*.parquet")) >= 5 and spark.read.parquet(path).count() == 1000
    files.write_partitioned(df, path + "2", "y")
    assert len(glob.glob(f"{path}2/y=1/*.parquet")) == 1


@pytest.mark.parametrize("mode", ["ref", "script", "words", "notebook"])
def test_long_blank_runs_are_linear(spark, mode):
    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b. ")).alias("text"))
    features.text_features(df, "text", None, mode).collect()  # compile
    t = time.perf_counter()
    row = features.text_features(df, "text", None, mode).first()
    assert time.perf_counter() - t < 5 and row["char_count"] == 1_000_004


def test_words_mode_counts_pieces_with_ink(spark):
    df = spark.createDataFrame([("a. . b!",), (" \n ",), ("...",), ("x",), ("a. ?!b",)], "text string")
    assert [r["sentence_count"] for r in features.text_features(df, "text", None, "words").collect()] == [2.0, 1.0, 1.0, 1.0, 2.0]


def test_pipeline_takes_null_text(spark):
    rows = [(i, None if i % 7 == 0 else f"word{i % 5} text number {i}", None if i % 5 == 0 else "sum", "g", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, summary string, group string, y int")
    _, train, test = models.prepare(df, vectors.build_pipeline("text", "summary", "group", num_features=64, min_doc_freq=1), "id", "y")
    assert train.count() + test.count() == 60
    assert vectors.build_simple_pipeline("text", 16, 1).fit(df).transform(df).count() == 60
    assert vectors.tokenize(df, "text").count() == 60
    assert not any("Indexer" in type(s).__name__ for s in vectors.build_pipeline().getStages())
    assert models.slot_names(train)[:2] == ["char_count", "word_count"]


def test_stratified_split_keeps_null_labels(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("y"))
    out = sampling.stratified_split(df, "y", "id", 0.2)
    got = {r["y"]: (r["n"], r["t"]) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    assert got == {None: (200, 40), 0: (400, 80), 1: (400, 80)}


def test_malformed_lines_do_not_depend_on_the_columns_read(spark):
    path = tempfile.mkdtemp()
    with open(f"{path}/a.csv", "w") as f:
        f.write('id,n\n1,2\n2,zz\n3\n4,5,6\n5,\\N\nx,1\n')
    kept = files.read_csv_lines(spark, path, spark.createDataFrame([], "id long, n long").schema)
    assert kept.count() == kept.select("id").count() == len(kept.select("n").collect()) == 2
    report = files.bad_row_count(files.read_csv_lines(spark, path, kept.schema, bad="keep")).first()
    assert (report["rows"], report["bad_rows"]) == (6, 4)


def test_class_profile_takes_the_classes_of_the_data(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 8.0), (None, 9.0)], "y int, x double")
    assert profile.class_profile(df, "y", ["x"]).first().asDict() == {"feature": "x", "mean_0": 1.0, "mean_1": 3.0, "mean_2": 8.0, "diff": 7.0}
    with pytest.raises(ValueError):
        profile.class_profile(df, "y", ["x"], classes=(0, 1))


def test_poisson_weights_have_mean_one(spark):
    cdf = poisson1_cdf()
    assert len(cdf) > 15 and cdf[-1] >= 1 - 2.0 ** -52
    x = with_stream_uniform(spark.range(200_000).select(key_hash64(F.col("id")).alias("h")), "h", F.lit(3), "u")
    m = x.agg(F.avg(poisson1_weight(F.col("u"))).alias("m"), F.avg("u").alias("u"), F.min("u"), F.max("u")).first()
    assert abs(m["m"] - 1) < 0.01 and abs(m["u"] - 0.5) < 0.003


def test_streams_are_not_shifts(spark):
    x = spark.range(3000).select(key_hash64(F.col("id")).alias("h"))
    u = with_stream_uniform(with_stream_uniform(x, "h", F.lit(1), "u1"), "h", F.lit(2), "u2")
    assert u.select("u1").distinct().count() == 3000
    assert abs(u.stat.corr("u1", "u2")) < 0.06
    assert u.select("u1").intersect(u.select("u2")).count() == 0


def test_exact_quantiles_and_ranks(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    data = [("a" if i % 3 else None, float(v)) for i, v in enumerate(np.round(rng.standard_normal(5000), 2))]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: (r["n"], r["q"]) for r in cumulative.exact_quantiles(df, "x", [0.25, 0.5, 0.99], ["g"], linear=True).collect()}
    for g in ("a", None):
        x = np.array([v for k, v in data if k == g])
        assert got[g][0] == len(x) and np.allclose(got[g][1], np.quantile(x, [0.25, 0.5, 0.99]))
    one = cumulative.exact_quantiles(df, "x", [0.0, 0.5, 1.0]).first()["q"]
    x = np.array([v for _, v in data])
    assert np.allclose(one, np.quantile(x, [0, 0.5, 1], method="inverted_cdf"))
    ranks = cumulative.row_numbers(spark.range(1000), [F.desc("id")], "r").orderBy("r").collect()
    assert [(r["id"], r["r"]) for r in ranks[:3]] == [(999, 1), (998, 2), (997, 3)] and ranks[-1]["r"] == 1000


def test_auc_of_many_scores_is_quick_and_drops_nulls(spark):
    df = spark.range(300_000).select((F.col("id") % 2).alias("label"), F.rand(1).alias("score"), F.lit(0).alias("prediction")).checkpoint()
    t = time.perf_counter()
    assert abs(evaluation.auc_roc(df).first()["auc"] - 0.5) < 0.01
    assert time.perf_counter() - t < 60
    holes = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.3)], "label int, score double")
    assert evaluation.auc_roc(holes).first()["auc"] == 1.0 and evaluation.unranked(holes).first()["unranked"] == 2


def test_dedup_of_tied_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 4, "w"), ("", 5, "e")], "k string, o int, v string")
    got = sorted((r["k"] or "~", r["o"], r["v"]) for r in clean.dedup(df, ["k"], "o").collect())
    assert got == sorted([("a", 1, "x"), ("~", 3, "z"), ("~", 5, "e")])
    assert profile.duplicate_count(df, "k").first().asDict() == {"rows": 6, "distinct_keys": 3, "duplicates": 3}


def test_group_distribution_without_a_limit(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("string").alias("g"))
    whole, top = profile.group_distribution(df, "g", k=None), profile.group_distribution(df, "g", k=30)
    assert whole.count() == 37 and sorted(whole.where("rank <= 30").collect()) == sorted(top.collect())


def test_checkpoint_folder_is_set(spark):
    assert ensure_checkpoint_dir(spark)
