"""Fits keep texts out of memory; a reloaded pipeline is asked for the test part only."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from vireo.operators import models as md
from vireo.operators import vectors as vec
from vireo.plans import load_all
from vireo.plans.registry import QUERIES
from vireo.sources import models as stored_models
from conftest import SF_SMALL


def test_fits_hold_no_texts(spark):
    pipe = vec.build_pipeline("text", "summary", None, num_features=64, min_doc_freq=1)
    df = spark.createDataFrame([(i, f"some words {i % 5} here", "some", float(i % 2)) for i in range(40)], "id long, text string, summary string, label double")
    _, out, held = md._fit_stages(pipe, df, keep=("id", "label", "features"))
    assert len(held) == 2 and "features" in out.columns
    for h in held:
        assert not {"text", "summary", "words", "filtered_words"} & set(h.columns)
        h.unpersist()


def test_unknown_stages_keep_all_columns(spark):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=64, include_group=True)
    assert md._reads(pipe.getStages()) is None and md._reads(pipe.getStages()[-2:]) >= {"tfidf", "raw_features", "char_count"}


def test_tree_batches_fit_a_few_cores():
    assert all(est.getMaxMemoryInMB() <= 256 for est in (md.random_forest(), md.decision_tree(), md.gbt()))


def test_roundtrip_transforms_the_test_part_only(spark, monkeypatch):
    load_all()
    seen = []

    class Spy:
        def __init__(self, model):
            self.model = model

        def transform(self, df):
            seen.append(df.count())
            return self.model.transform(df)

    load = stored_models.load_pipeline
    monkeypatch.setattr(stored_models, "load_pipeline", lambda path: Spy(load(path)))
    out = QUERIES["model_roundtrip"](spark, SF_SMALL).collect()
    assert seen == [len(out)] and all(r["same"] for r in out)


def _vectors(spark, rows, width=4):
    cols = [F.rand(i).alias(f"x{i}") for i in range(width)]
    df = spark.range(rows).select("id", (F.col("id") % 2).cast("double").alias("label"), *cols)
    return vec.assembler([f"x{i}" for i in range(width)], "features").transform(df).select("id", "label", "features")


def test_training_partitions_fill_whole_rounds_of_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = _vectors(spark, 40 * (cores + 1))
    monkeypatch.setattr(md, "CELLS_PER_PARTITION", 40 * 4)  # one partition more than there are cores
    whole, part = md.cache_for_fit(df), md.cache_for_fit(df, share=2 / 3)
    assert (whole.rdd.getNumPartitions(), part.rdd.getNumPartitions()) == (2 * cores, cores)
    assert whole.count() == part.count() == df.count()
    whole.unpersist()
    part.unpersist()


def test_tree_fits_that_outgrow_the_memory_run_one_by_one(spark, monkeypatch):
    df = _vectors(spark, 90)
    pools = []

    class Pool(ThreadPoolExecutor):
        def __init__(self, n):
            pools.append(n)
            super().__init__(n)

    monkeypatch.setattr(md, "ThreadPoolExecutor", Pool)
    grid = {"maxIter": [1, 2], "maxDepth": [2]}
    tables = [md.tune_boosting(grid, df, "id", parallelism=3).orderBy("combo").collect()]
    monkeypatch.setattr(md, "_storage_bytes", lambda s: 90 * 4 * 4)  # all rows, once
    tables.append(md.tune_boosting(grid, df, "id", parallelism=3).orderBy("combo").collect())
    assert pools == [3, 1] and tables[0] == tables[1]
    assert md.fits_at_once(md.random_forest(), df, 2 / 3, 4) == 1 and md.fits_at_once(md.logistic(), df, 2 / 3, 4) == 4
    cv = md.tune(md.random_forest(num_trees=2), {"maxDepth": [2, 3]}, df, "id", parallelism=4)
    assert cv.getEstimatorParamMaps() and len(cv.avgMetrics) == 2
