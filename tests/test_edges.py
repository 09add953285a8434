"""Edge frames: empty input, one class only, constant column, unseen group,
and the three-row transformer fixture."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators import evaluation as ev
from vireo.operators import label, profile
from vireo.operators.features import text_features


def test_empty_frame_profiles(spark):
    df = spark.createDataFrame([], "id long, text string, grp string")
    m = {r["column"]: r for r in profile.missing_profile(df).collect()}
    assert m["text"]["missing"] == 0 and m["text"]["pct"] == 0.0
    assert profile.duplicate_count(df, "text").first()["rows"] == 0
    assert label.activity_label(df, "grp").count() == 0


def test_one_class_only(spark):
    df = spark.createDataFrame([(i, 1, 1, float(i)) for i in range(10)],
                               "doc_id long, label int, prediction int, score double")
    m = ev.class_metrics(df).first()
    assert m["accuracy"] == 1.0 and m["f1"] == 1.0
    assert ev.auc_roc(df).first()["auc"] is None        # no negatives: undefined, not an error


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    assert profile.correlation_matrix(df, ["a", "b"]).first()["corr"] is None


def test_unseen_group_gets_extra_index(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "g string")
    model = StringIndexer(inputCol="g", outputCol="i", handleInvalid="keep").fit(train)
    got = {r["g"]: r["i"] for r in model.transform(test).collect()}
    assert got["a"] == 0.0 and got["zzz"] == 2.0 and got[None] == 2.0


def test_sample_fixture_transformers(spark):
    rows = [("Is this working? Yes! Really!", "short"),
            ("two words", "tw"),
            ("LOUD TEXT!!!!\n\nSee https://example.com now", "loud")]
    df = spark.createDataFrame(rows, "body string, summary string")
    out = text_features(df, "body", "summary", "ref")
    assert out.count() == 3
    assert set(NUMERIC_FEATURES) <= set(out.columns)
    for r in out.collect():
        assert 0.0 <= r["uppercase_ratio"] <= 1.0
        assert r["has_url"] in (0.0, 1.0)
        assert r["char_count"] >= r["summary_length"] or r["content_density"] > 1.0
    loud = out.where(F.col("summary") == "loud").first()
    assert loud["exclamation_count"] == 4.0 and loud["has_url"] == 1.0 and loud["paragraph_count"] == 2.0


def test_all_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, text string")
    out = text_features(df, "text", None, "ref").collect()
    assert all(r["char_count"] == 0.0 and r["word_count"] == 1.0 for r in out)
    with pytest.raises(ValueError):
        text_features(df, "text", None, "nope")


def test_class_profile_of_many_classes_is_long(spark, monkeypatch):
    from vireo.operators import profile

    monkeypatch.setattr(profile, "MAX_CLASSES", 3)
    rows = spark.createDataFrame([(i % 5, float(i), None if i == 3 else 2.0 * i) for i in range(20)] + [(None, 99.0, 1.0)], "y int, a double, b double")
    got = {(r["y"], r["feature"]): r["mean"] for r in profile.class_profile(rows, "y", ["a", "b"]).collect()}
    mean = lambda v: round(sum(v) / len(v), 6)
    want = {(y, "a"): mean(range(y, 20, 5)) for y in range(5)} | {(y, "b"): mean([2.0 * i for i in range(y, 20, 5) if i != 3]) for y in range(5)}
    assert got == want
    assert profile.class_profile(rows.where("y < 3"), "y", ["a"]).columns == ["feature", "mean_0", "mean_1", "mean_2", "diff"]
    assert profile.class_profile_long(rows.limit(0), "y", ["a"]).count() == 0
