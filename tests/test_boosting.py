"""Boosted trees grown from filled slots are those of ``GBTClassifier``."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from vireo.operators import boosting as bo
from vireo.operators import models as md


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows, two dense slots, thirty that few rows fill (one never, one always the same), vectors of both kinds."""
    rng, out = np.random.default_rng(7), []
    for i in range(900):
        x = np.zeros(34)
        x[:2] = rng.normal(size=2)
        x[2:32] = np.where(rng.random(30) < 0.15, rng.integers(1, 5, 30) * 0.7, 0.0)
        x[33] = 2.5
        y = float(x[0] + 0.6 * (x[3] > 0) - 0.8 * (x[9] > 0) + 0.3 * x[1] * x[5] + 0.3 * rng.normal() > 0.2)
        v = Vectors.dense(x) if i % 3 == 0 else Vectors.sparse(34, np.flatnonzero(x).tolist(), x[x != 0].tolist())
        out.append((i, y, v))
    df = spark.createDataFrame(out, ["id", "label", "features"]).repartition(4, "id").cache()
    df.count()
    yield df
    df.unpersist()


def _trees(model) -> list[str]:
    text = re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m.group()):.9g}", model.toDebugString)
    return text.split("\n")[1:]


@pytest.fixture(scope="module")
def plain(rows):
    return md.gbt(12, 4, minInstancesPerNode=15).fit(rows)


def _refuse(*_):
    raise AssertionError("every slot of every row was read")


def test_one_task_grows_the_same_trees_from_filled_slots(rows, plain, monkeypatch):
    monkeypatch.setattr(GBTClassifier, "_fit", _refuse)  # the learner that bins all slots, as before
    made = md.fit(md.gbt(12, 4, minInstancesPerNode=15), rows)
    assert _trees(made) == _trees(plain) and made.totalNumNodes == plain.totalNumNodes
    assert made.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray())
    assert (made.numFeatures, made.numClasses, made.treeWeights, made.getMaxDepth()) == (34, 2, plain.treeWeights, 4)


def test_many_tasks_blocks_and_batches_grow_the_same_trees(rows, plain, monkeypatch):
    monkeypatch.setattr(bo, "ENTRIES_IN_ONE", 0)
    monkeypatch.setattr(bo, "ENTRIES_PER_TASK", 1500)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 60)
    monkeypatch.setattr(bo, "SUMS_BYTES", 2 * 16 * 200)  # a node or two at once
    est = md.gbt(12, 4, minInstancesPerNode=15)
    binned = bo.bin_rows(est, rows)
    assert binned.blocks.getNumPartitions() > 1 and binned.blocks.count() >= 15
    assert _trees(bo.fit(est, binned)) == _trees(plain)
    held, filled = binned.blocks.map(lambda b: len(b.rows)).sum(), rows.rdd.map(lambda r: r["features"].numNonzeros()).sum()
    assert held <= filled == binned.filled < 900 * 34 / 4
    binned.release()


def test_leaves_keep_their_rows(rows):
    est = md.gbt(3, 3)
    binned = bo.bin_rows(est, rows)
    made, plain = bo.fit(est, binned), est.fit(rows)
    binned.release()

    def walk(a, b):
        for x, y in zip(a.impurityStats().stats(), b.impurityStats().stats()):
            assert x == pytest.approx(y, abs=1e-9)
        assert a.impurityStats().rawCount() == b.impurityStats().rawCount() and a.impurity() == pytest.approx(b.impurity(), abs=1e-12)
        if a.getClass().getSimpleName() == "InternalNode":
            walk(a.leftChild(), b.leftChild())
            walk(a.rightChild(), b.rightChild())
    walk(made._java_obj.trees()[0].rootNode(), plain._java_obj.trees()[0].rootNode())


def test_tuning_reads_filled_slots_only(rows, monkeypatch):
    grid = {"maxIter": [2, 4], "maxDepth": [2, 3], "stepSize": [0.1]}
    want = {r["params"]: r["mean_auc"] for r in md.cv_table(md.tune(md.gbt(minInstancesPerNode=15), grid, rows, "id", folds=2)).collect()}
    plain_gbt = md.gbt
    monkeypatch.setattr(md, "gbt", lambda *a, **kw: plain_gbt(*a, **{"minInstancesPerNode": 15, **kw}))
    monkeypatch.setattr(GBTClassifier, "_fit", _refuse)
    got = {r["params"]: r["mean_auc"] for r in md.tune_boosting(grid, rows, "id", folds=2).collect()}
    assert got == pytest.approx(want) and len(got) == 4


def test_other_settings_and_refused_rows_go_to_the_plain_learner(spark, rows):
    assert bo.covers(md.gbt(), rows)
    for est in (md.gbt(subsamplingRate=0.5), md.gbt(featureSubsetStrategy="sqrt"), md.gbt(weightCol="id"), md.gbt(validationIndicatorCol="id")):
        assert not bo.covers(est, rows)
    nominal = rows.select("label", F.col("features").alias("features", metadata={"ml_attr": {"attrs": {"nominal": [{"idx": 0}]}, "num_attrs": 34}}))
    assert not bo.covers(md.gbt(), nominal)
    assert bo.bin_rows(md.gbt(), rows.where("id < 0")) is None
    with pytest.raises(Exception):
        md.fit(md.gbt(2, 2), rows.withColumn("label", F.when(F.col("id") > 5, F.col("label"))))
    model = md.fit(md.gbt(2, 2, subsamplingRate=0.5), rows)
    assert model.getNumTrees == 2


def test_summary_of_a_boosted_fit_reads_filled_slots_only(rows, plain, monkeypatch):
    monkeypatch.setattr(GBTClassifier, "_fit", _refuse)
    made = md.model_summary("gbt", md.fit(md.gbt(12, 4, minInstancesPerNode=15), md.cache_for_fit(rows))).collect()
    assert {r["item"]: r["value"] for r in made} == {"trees": 12.0, "total_nodes": float(plain.totalNumNodes)}


def test_thresholds_part_rows_in_equal_shares():
    assert bo.slot_thresholds(np.array([1.0, 3.0]), np.array([2, 2]), 10, 31).tolist() == [0.5, 2.0]
    assert bo.slot_thresholds(np.array([4.0]), np.array([10]), 10, 31).tolist() == []  # one value in all rows
    assert bo.slot_thresholds(np.arange(1.0, 9.0), np.ones(8, dtype=int), 8, 3).tolist() == [2.5, 4.5, 6.5]
    assert bo.slot_thresholds(np.array([-1.0, 2.0]), np.array([1, 1]), 100, 1).tolist() == [1.0]  # 98 rows are zero
