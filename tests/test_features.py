"""Edge fixtures for the text features (measured semantics of Spark 4.1, ANSI on)."""

import pytest
from pyspark.sql import functions as F

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators.features import SummaryFeatures, TextFeatures, text_features

# (text, word_count, sentence_count (ref), paragraphs, distinct on space)
EDGES = [
    ("", 1, 1, 1, 1),
    ("Hello.", 1, 2, 1, 1),
    ("a b  c ", 4, 1, 1, 4),
    ("no end", 2, 1, 1, 2),
    ("a\n\nb", 2, 1, 2, 1),
    ("A! B? C...D", 3, 4, 1, 3),
]


@pytest.fixture(scope="module")
def edge_df(spark):
    rows = [(i, t) for i, (t, *_rest) in enumerate(EDGES)] + [(len(EDGES), None)]
    return spark.createDataFrame(rows, "id int, text string")


def test_ref_mode_edges(edge_df):
    out = {r["id"]: r for r in text_features(edge_df, "text", None, "ref").collect()}
    for i, (t, wc, sc, pc, _d) in enumerate(EDGES):
        assert out[i]["word_count"] == wc, t
        assert out[i]["sentence_count"] == sc, t
        assert out[i]["paragraph_count"] == pc, t
    # null text is filled with '' first
    assert out[len(EDGES)]["word_count"] == 1.0


def test_distinct_words_on_space(edge_df):
    out = edge_df.select("id", F.size(F.array_distinct(F.split("text", " "))).alias("d")).collect()
    got = {r["id"]: r["d"] for r in out}
    for i, (*_x, d) in enumerate(EDGES):
        assert got[i] == d


def test_script_and_words_modes(spark):
    df = spark.createDataFrame([(1, "Hello World! Is it?  Yes.", "Hi there"), (2, None, None)],
                               "id int, text string, summary string")
    s = {r["id"]: r for r in text_features(df, "text", "summary", "script").collect()}
    assert s[1]["exclamation_count"] == 1 and s[1]["question_count"] == 1
    assert s[1]["sentence_count"] == 3.0          # 4 pieces - 1
    assert s[1]["uppercase_ratio"] == pytest.approx(4 / 25)
    assert all(s[2][c] == 0.0 for c in NUMERIC_FEATURES)   # nulls -> 0.0
    w = {r["id"]: r for r in text_features(df, "text", "summary", "words").collect()}
    assert w[1]["word_count"] == 5.0                # str.split()
    assert w[1]["avg_word_length"] == pytest.approx(4.0)
    assert w[1]["sentence_count"] == 3.0
    assert w[1]["summary_word_count"] == 2.0


def test_unicode_uppercase_script_mode(spark):
    df = spark.createDataFrame([(1, "ÉTÉ été")], "id int, text string")
    r = text_features(df, "text", None, "script").first()
    assert r["uppercase_ratio"] == pytest.approx(3 / 7)
    r = text_features(df, "text", None, "ref").first()
    assert r["uppercase_ratio"] == pytest.approx(1 / 7)   # ASCII [A-Z] only


def test_transformers_equal_function(spark):
    df = spark.createDataFrame([(1, "One. Two!\n\nThree?", "One")], "id int, text string, summary string")
    a = SummaryFeatures(inputCol="summary").transform(TextFeatures(inputCol="text").transform(df)).first()
    b = text_features(df, "text", "summary", "ref").first()
    for c in NUMERIC_FEATURES:
        assert a[c] == pytest.approx(b[c]), c


def test_summary_features_need_char_count(spark):
    df = spark.createDataFrame([(1, "x")], "id int, summary string")
    with pytest.raises(ValueError):
        SummaryFeatures(inputCol="summary").transform(df)


def test_feature_plan_has_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for mode in ("ref", "script", "words"):
        plan = text_features(df, "text", None, mode)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_notebook_mode(spark):
    df = spark.createDataFrame([(1, "A! B? C...D\n\nE", "x y"), (2, "", "")], "id int, text string, s string")
    r = {x["id"]: x for x in text_features(df, "text", "s", "notebook").collect()}
    assert r[1]["sentence_count"] == 3.0          # runs of [.!?]
    assert r[1]["paragraph_count"] == 2.0         # blank lines + 1
    assert r[1]["word_count"] == 4.0 and r[1]["summary_word_count"] == 2.0
    assert r[2]["word_count"] == 0.0 and r[2]["avg_word_length"] == 0.0
