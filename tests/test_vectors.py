"""Term statistics against Spark ML, vocabulary TF-IDF norms, group index."""

import math

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vireo.operators import vectors as vec


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


def test_tokenizer_keeps_inner_empty_tokens(spark):
    df = spark.createDataFrame([("Hello  World ",)], "text string")
    assert vec.tokenize(df, "text").first()["words"] == ["hello", "", "world"]


def test_hashing_total_equals_tokens(docs):
    tf = vec.hashing_tf(vec.remove_stopwords(vec.tokenize(docs, "text")), num_features=5000)
    r = tf.select(F.aggregate(vector_to_array("raw_tf"), F.lit(0.0), lambda a, x: a + x).alias("t"),
                  F.size("filtered_words").alias("n")).collect()
    assert all(x["t"] == x["n"] for x in r)


def test_term_stats_idf_matches_spark_idf_rule(docs):
    ts = vec.term_stats(docs, "doc_id", "text", min_doc_freq=2)
    n = docs.count()
    for r in ts.limit(50).collect():
        assert r["idf"] == pytest.approx(vec.idf_value(n, r["df"], 2))


def test_vocab_rows_have_unit_norm(docs):
    v = vec.vocab_tfidf(docs, "doc_id", "text", max_features=300, min_df=2, max_df=0.9)
    norms = v.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("n")).collect()
    assert norms and all(abs(r["n"] - 1.0) < 1e-9 for r in norms)
    assert v.select("term").distinct().count() <= 300


def test_group_index_equals_string_indexer(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.col("user_id").cast("string").alias("u"))
    table = {r["u"]: r["index"] for r in vec.group_index_table(ev, "u").collect()}
    model = StringIndexer(inputCol="u", outputCol="i", handleInvalid="keep").fit(ev)
    assert {lab: float(i) for i, lab in enumerate(model.labels)} == {k: v for k, v in table.items() if k is not None}


def test_scale_columns_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    out = vec.scale_columns(df, ["a", "b"]).collect()
    sd = math.sqrt(sum((x - 7 / 3) ** 2 for x in (1, 2, 4)) / 2)
    assert [r["a"] for r in out] == pytest.approx([1 / sd, 2 / sd, 4 / sd])
    assert all(r["b"] == 0.0 for r in out)


def test_term_stats_salted_join_equals_broadcast(docs):
    a = vec.term_stats(docs, "doc_id", "text").select("doc_id", "term", "tf", "df")
    b = vec.term_stats(docs, "doc_id", "text", max_broadcast_bytes=0).select("doc_id", "term", "tf", "df")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
