"""Spark ML classifiers, training loop, tuning and model introspection.

Training data is assembled once, split by key hash (reproducible under any
partitioning), and persisted only around the fits.  Preprocessing (IDF,
scaler, indexer) is fitted on the training part only.  Cross-validation
folds come from the key hash too, so the folds are the same on every run.
"""

from __future__ import annotations

import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.operators import boosting
from vireo.operators import evaluation as ev
from vireo.operators.joins import materialize
from vireo.operators.sampling import fold_column, split_column


# Execution settings for tree learners (they change speed, not the model):
# larger histogram batches mean fewer passes over the data per tree level, but every
# running task holds one batch on the heap beside the cached rows (four cores of
# 1024 MB were 4 GB of an executor); cached node ids avoid re-walking deep trees for every row.
TREE_MEMORY_MB = 256


# The base model settings (notebook defaults).
def logistic(max_iter: int = 100, reg: float = 0.01, elastic: float = 0.0, **kw) -> LogisticRegression:
    """G1: L2 logistic regression."""
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg,
                              elasticNetParam=elastic, **kw)


def random_forest(num_trees: int = 100, max_depth: int = 10, seed: int = 42, **kw) -> RandomForestClassifier:
    """Random forest."""
    kw = {"maxMemoryInMB": TREE_MEMORY_MB, "cacheNodeIds": True, **kw}
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, **kw)


def decision_tree(max_depth: int = 10, seed: int = 42, **kw) -> DecisionTreeClassifier:
    """Decision tree."""
    kw = {"maxMemoryInMB": TREE_MEMORY_MB, "cacheNodeIds": True, **kw}
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=max_depth, seed=seed, **kw)


def gbt(max_iter: int = 50, max_depth: int = 5, step: float = 0.1, seed: int = 42, **kw) -> GBTClassifier:
    """Gradient-boosted trees."""
    kw = {"maxMemoryInMB": TREE_MEMORY_MB, **kw}
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, seed=seed, **kw)


def base_models(script: bool = False) -> dict:
    """The four base models; ``script`` uses the batch script's sizes."""
    if script:
        return {"logistic_regression": logistic(max_iter=50), "random_forest": random_forest(num_trees=50),
                "decision_tree": decision_tree(max_depth=15), "gbt": gbt(max_depth=8)}
    return {"logistic_regression": logistic(), "random_forest": random_forest(),
            "decision_tree": decision_tree(), "gbt": gbt()}


def _reads(stages: list) -> set[str] | None:
    """The columns that ``stages`` read; None where a stage (SQL, a custom one) does not tell them all."""
    out: set[str] = set()
    for st in stages:
        given = [st.getOrDefault(p) for p in ("inputCol", "inputCols") if st.hasParam(p) and st.isDefined(p)]
        if not given or not type(st).__module__.startswith("pyspark.ml."):
            return None
        for g in given:
            out |= {g} if isinstance(g, str) else set(g)
    return out


def _fit_stages(pipeline: Pipeline, df: DataFrame, training=None, keep: tuple[str, ...] = ()):
    """Fit every stage in turn; returns the model and ``df`` after all stages.

    The frame in front of each estimator is persisted, so the stages before it run once for all of ``df``;
    estimators see the rows where ``training`` holds.  Only ``keep`` and what later stages read is persisted and
    returned: texts and word lists, many times the size of the vectors, stay out of memory.  Also returns
    the persisted frames, for their release.
    """
    stages, held, cur = [], [], df
    for i, st in enumerate(pipeline.getStages()):
        if isinstance(st, Estimator):
            read = _reads(pipeline.getStages()[i:])
            if read is not None:
                cur = cur.select(*[F.col(f"`{c}`") for c in cur.columns if c in read or c in keep])
            cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(cur)
            st = st.fit(cur if training is None else cur.where(training))
        stages.append(st)
        cur = st.transform(cur)
    return PipelineModel(stages=stages), cur, held


def fit_pipeline(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """``pipeline.fit`` with each stage in front of an estimator run once; the same ``PipelineModel``."""
    model, _, held = _fit_stages(pipeline, df)
    for h in held:
        h.unpersist()
    return model


def prepare(df: DataFrame, pipeline: Pipeline, key: str, label: str, test_fraction: float = 0.2,
            seed: int = 42):
    """Split ``df`` by key hash, fit ``pipeline`` on the training part only,
    and return ``(model, train, test)`` with ``features`` and ``label``.

    Both parts go through the stages together, once, while the estimators are fitted; the finished
    vectors are stored, so fits, scores and counts never run a feature stage again.
    """
    part = split_column(key, [1.0 - test_fraction, test_fraction], seed)
    tagged = df.withColumn("__part", part).withColumn("label", F.col(label).cast("double"))
    model, out, held = _fit_stages(pipeline, tagged, F.col("__part") == 0, (key, "label", "features", "__part"))
    names = {f.name: f.metadata for f in out.schema.fields}
    stored = materialize(out.select(key, "label", "features", "__part"))
    for h in held:
        h.unpersist()
    # a checkpoint drops column metadata, and the scaler drops the slots' names, which keep their order
    stored = stored.select(key, "label", F.col("features").alias("features", metadata=names.get("raw_features") or names["features"]), "__part")
    return model, stored.where("__part = 0").drop("__part"), stored.where("__part = 1").drop("__part")


#: Vector slots (rows x width) that one training partition aims at.
CELLS_PER_PARTITION = 50_000_000


def _width(df: DataFrame) -> int:
    """Slots of the frame's vectors."""
    first = df.select("features").first()
    return max(len(first[0]), 1) if first is not None else 1


def _partitions_for(df: DataFrame, rows: int) -> int:
    """Training partitions by rows and vector width."""
    return max(1, -(-rows * _width(df) // CELLS_PER_PARTITION))


def cache_for_fit(df: DataFrame, share: float = 1.0) -> DataFrame:
    """Persist a training frame sized for iterative fitting: every optimiser iteration or tree level is
    one job over it, so it gets balanced partitions, one per core at least and more by rows and width.

    Their number is a multiple of the cores: nine equal tasks on eight cores take as long as sixteen.  ``share``
    is the part of the rows that one fit sees (cross-validation's training folds).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = -(-_partitions_for(df, math.ceil(df.count() * share)) // cores)
    out = df.repartition(rounds * cores).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def _storage_bytes(spark: SparkSession) -> int:
    """Memory for cached blocks in the whole session."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().toList()
    return sum(status.apply(i)._1() for i in range(status.size()))


def fits_at_once(estimator, train: DataFrame, share: float, parallelism: int, slots: int | None = None) -> int:
    """How many of the ``parallelism`` fits may run together: a tree learner caches four bytes for every slot
    of its rows (``slots``, where it holds only some of them), and fits whose rows together outgrow the memory
    read them from disk once a tree level."""
    if not estimator.hasParam("maxBins"):
        return parallelism
    one = (train.count() * share * _width(train) if slots is None else slots) * 4
    return max(1, min(parallelism, int(_storage_bytes(train.sparkSession) * 0.8 // max(one, 1))))


def fit(estimator, train: DataFrame):
    """Fit on a frame prepared by ``cache_for_fit``.

    Tree learners use every partition.  A linear model's iteration is one light aggregation whose cost on
    small data is task scheduling, so it reads the cached partitions coalesced by rows and width.  Boosted trees
    grow from the slots that rows fill (``boosting``).
    """
    if isinstance(estimator, LogisticRegression):
        train = train.coalesce(_partitions_for(train, train.count()))
    if isinstance(estimator, GBTClassifier) and boosting.covers(estimator, train):
        binned = boosting.bin_rows(estimator, train)
        if binned is not None:
            try:
                return boosting.fit(estimator, binned)
            finally:
                binned.release()
    return estimator.fit(train)


def score(model, df: DataFrame) -> DataFrame:
    """Raw scores, probability, prediction and the positive score."""
    return ev.positive_score(model.transform(df), "probability", "score")


def train_all(train: DataFrame, test: DataFrame, estimators: dict, key: str = "id"):
    """Fit each estimator (timed), score the test part, and return
    ``(fitted, metrics)`` where metrics has one row per model with
    accuracy, precision, recall, f1, auc and train_seconds.  All models' test scores are evaluated in one pass."""
    train = cache_for_fit(train)
    fitted, timings = {}, []
    try:
        for name, est in estimators.items():
            t0 = time.perf_counter()
            fitted[name] = fit(est, train)
            timings.append((name, time.perf_counter() - t0))
    finally:
        train.unpersist()
    metrics = ev.compare_models({name: score(model, test) for name, model in fitted.items()})
    times = train.sparkSession.createDataFrame(timings, "model string, train_seconds double")
    return fitted, metrics.join(times, "model")


# The published tuning grids of the batch run and of the tuning notebook.
GRIDS = {
    "batch": {
        "logistic_regression": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [50, 100]},
        "random_forest": {"numTrees": [30, 50], "maxDepth": [8, 12]},
        "gbt": {"maxIter": [30, 50], "maxDepth": [5, 8], "stepSize": [0.05, 0.1]},
    },
    "notebook": {
        "logistic_regression": {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100]},
        "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5]},
        "gbt": {"maxIter": [30, 50, 100], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1, 0.2]},
    },
}


def tune(estimator, grid: dict, train: DataFrame, key: str, folds: int = 3, parallelism: int = 2,
         seed: int = 42):
    """K-fold cross-validation over ``grid`` ({param: [values]}) with
    AUC; folds come from the key hash (``foldCol``), not a random split.  ``parallelism`` fits run
    together, fewer where their rows outgrow the memory."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(estimator.getParam(param) if isinstance(param, str) else param, values)
    share = (folds - 1) / folds
    data = cache_for_fit(train.withColumn("__fold", fold_column(key, folds, seed)), share)
    try:
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(),
                            evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
                            numFolds=folds, foldCol="__fold", parallelism=fits_at_once(estimator, data, share, parallelism), seed=seed)
        return cv.fit(data)
    finally:
        data.unpersist()


def boosting_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` rounds: what a fit with a smaller ``maxIter`` and all else equal gives."""
    sc = SparkContext._active_spark_context
    whole = model._java_obj
    trees = whole.trees()
    n = min(rounds, len(trees))
    kept = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        kept[i], weights[i] = trees[i], float(whole.treeWeights()[i])
    return GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{n}", kept, weights))


def tune_boosting(grid: dict[str, list], train: DataFrame, key: str, folds: int = 3, parallelism: int = 2, seed: int = 42) -> DataFrame:
    """G6 and G7 for GBT: the table of ``cv_table`` over ``grid`` with one fit per fold and combination but ``maxIter``.

    Boosting adds trees and never changes earlier ones, so the longest fit holds every shorter one: its
    prefixes are scored on the fold's held-back rows in one pass each.  Without row or feature sampling
    (the settings here) prefixes equal full fits.  Trees grow from the slots that rows fill (``boosting``).
    """
    names = list(grid)
    lengths = sorted(grid.get("maxIter", [20]))
    others = [n for n in names if n != "maxIter"]
    share = (folds - 1) / folds
    data = cache_for_fit(train.withColumn("__fold", fold_column(key, folds, seed)), share)
    binned: dict[int, boosting.Binned | None] = {}

    def estimator(combo: tuple) -> GBTClassifier:
        est = gbt(max_iter=lengths[-1])
        return est.copy({est.getParam(n): v for n, v in zip(others, combo)})

    def scores(job) -> list[tuple]:
        combo, fold = job
        est = estimator(combo)
        rows = data.where(F.col("__fold") != fold)
        model = boosting.fit(est, binned[fold]) if binned.get(fold) is not None else est.fit(rows)
        held = data.where(F.col("__fold") == fold)
        evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
        return [(combo, m, evaluator.evaluate(boosting_prefix(model, m).transform(held))) for m in lengths]

    combos = list(itertools.product(*[grid[n] for n in others]))
    try:
        # a fold's rows are binned once for all its fits, which needs the same bins in all of them
        if "maxBins" not in others and all(boosting.covers(estimator(c), data) for c in combos):
            for fold in range(folds):
                binned[fold] = boosting.bin_rows(gbt(), data.where(F.col("__fold") != fold))
        slots = max(b.filled for b in binned.values()) if binned and all(binned.values()) else None
        with ThreadPoolExecutor(fits_at_once(gbt(), data, share, parallelism, slots)) as pool:
            jobs = [(combo, fold) for combo in combos for fold in range(folds)]
            found = [x for part in pool.map(inheritable_thread_target(train.sparkSession)(scores), jobs) for x in part]
    finally:
        for b in binned.values():
            if b is not None:
                b.release()
        data.unpersist()
    means: dict[tuple, float] = {}
    for combo, m, auc in found:
        means[combo, m] = means.get((combo, m), 0.0) + auc / folds
    rows = []
    for i, values in enumerate(itertools.product(*grid.values())):
        given = dict(zip(names, values))
        mean = means[tuple(given[n] for n in others), given.get("maxIter", lengths[-1])]
        rows.append((i, ", ".join(f"{n}={v}" for n, v in sorted(given.items())), float(mean)))
    best = max(rows, key=lambda r: r[2])[0]
    return train.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], "combo int, params string, mean_auc double, best boolean")


def cv_table(cv_model) -> DataFrame:
    """Every parameter combination with its mean AUC, and a best flag."""
    maps, metrics = cv_model.getEstimatorParamMaps(), cv_model.avgMetrics
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             float(metrics[i]), i == best) for i, m in enumerate(maps)]
    from pyspark.sql import SparkSession
    return SparkSession.active().createDataFrame(rows, "combo int, params string, mean_auc double, best boolean")


def feature_importance(model, names: list[str] | None = None, k: int = 15) -> DataFrame:
    """Top-k importances with feature names (sums to 1 over all slots)."""
    from pyspark.sql import SparkSession
    imp = model.featureImportances
    rows = [(int(i), (names[i] if names and i < len(names) else f"f{i}"), float(v))
            for i, v in zip(imp.indices, imp.values)]
    df = SparkSession.active().createDataFrame(rows, "index int, name string, importance double")
    return df.orderBy(F.desc("importance"), "index").limit(k)


def slot_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the slots of an assembled vector from its ML metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    n = meta.get("num_attrs", 0)
    names = [f"f{i}" for i in range(n)]
    for kind in meta.get("attrs", {}).values():
        for a in kind:
            if a["idx"] < n:
                names[a["idx"]] = a.get("name", names[a["idx"]])
    return names


def model_summary(name: str, model) -> DataFrame:
    """``(model, item, value)`` -- LR objective tail and iterations,
    tree depth and nodes, ensemble tree count and total nodes."""
    from pyspark.sql import SparkSession
    rows = []
    if hasattr(model, "summary") and hasattr(model, "coefficients"):
        hist = model.summary.objectiveHistory
        rows += [("iterations", float(model.summary.totalIterations)), ("final_objective", float(hist[-1]))]
    if hasattr(model, "depth") and hasattr(model, "numNodes"):
        rows += [("depth", float(model.depth)), ("nodes", float(model.numNodes))]
    if hasattr(model, "getNumTrees"):
        rows += [("trees", float(model.getNumTrees)), ("total_nodes", float(model.totalNumNodes))]
    return SparkSession.active().createDataFrame([(name, k, v) for k, v in rows],
                                                 "model string, item string, value double")
