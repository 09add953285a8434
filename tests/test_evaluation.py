"""Golden confusion cells, AUC against Spark's evaluator, ROC and resampling invariants."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF_CHECK
from vireo.operators import evaluation as ev
from vireo.plans.registry import scored_labels

# The published confusion cells and metrics of the four models.
GOLDEN = [
    ("LR", 11960, 16, 3988, 36, 0.7485, 0.6392654878, 0.6437586418),
    ("RF", 11996, 0, 4004, 0, 0.74975, 0.5621250625, 0.6425204315),
    ("DT", 11757, 142, 3862, 239, 0.7436875, 0.6576336329, 0.6546151953),
    ("GBT", 11976, 42, 3962, 20, 0.751125, 0.7328951309, 0.6480428606),
]


@pytest.mark.parametrize("name,tp,tn,fp,fn,acc,prec,f1", GOLDEN)
def test_golden_cells(spark, name, tp, tn, fp, fn, acc, prec, f1):
    cells = spark.createDataFrame([(1, 1, tp), (0, 0, tn), (0, 1, fp), (1, 0, fn)],
                                  "label int, prediction int, n long")
    m = ev.metrics_from_cells(cells).first()
    assert m["accuracy"] == pytest.approx(acc, abs=1e-9)
    assert m["precision"] == pytest.approx(prec, abs=1e-9)
    assert m["f1"] == pytest.approx(f1, abs=1e-9)
    assert m["recall"] == pytest.approx(acc, abs=1e-12)   # weighted recall = accuracy


@pytest.fixture(scope="module")
def scored(spark):
    return scored_labels(spark, SF_CHECK).cache()


def test_auc_equals_spark_evaluator(scored):
    ours = ev.auc_roc(scored, digits=None).first()["auc"]
    frame = scored.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction"))
    theirs = BinaryClassificationEvaluator(numBins=0).evaluate(frame)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_bucket_count_does_not_matter(scored):
    a = ev.auc_roc(scored, digits=None).first()[0]
    b = ev.auc_roc(scored.repartition(7), digits=None).first()[0]
    assert a == pytest.approx(b, abs=1e-15)


def test_roc_monotone_and_trapezoid(scored):
    pts = sorted((r["fpr"], r["tpr"]) for r in ev.roc_points(scored).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    assert all(b[1] >= a[1] for a, b in zip(pts, pts[1:]))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert area == pytest.approx(ev.auc_roc(scored).first()[0], abs=1e-5)


def test_bootstrap_interval_contains_point(scored):
    rows = {r["metric"]: r for r in ev.bootstrap_ci(scored, "doc_id", replicates=50).collect()}
    for m in ("accuracy", "f1"):
        assert rows[m]["lower"] <= rows[m]["point"] <= rows[m]["upper"]


def test_bootstrap_sizes_average_to_n(scored):
    n = scored.count()
    sizes = [r["size"] for r in ev.bootstrap_replicates(scored, "doc_id", replicates=40).collect()]
    mean = sum(sizes) / len(sizes)
    assert abs(mean - n) < 4 * (n ** 0.5) / (len(sizes) ** 0.5) + 1


def test_confusion_sums_to_rows(scored):
    assert ev.confusion(scored).agg(F.sum("n")).first()[0] == scored.count()


def test_stability_grade_values(scored):
    g = ev.stability_grade(ev.stability(scored, "doc_id")).first()
    assert g["grade"] in {"HIGH", "MODERATE", "LOW"}
