"""Model queries on documents ⋈ labels, label = quality, with the published settings.

Fitted values depend on the learner, so the SQL twins check what is fixed: which rows are test rows,
their labels, the combinations of a grid, and that every fitted value is in its range.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vireo.operators import evaluation as ev
from vireo.operators import label as lb
from vireo.operators import models as md
from vireo.operators import vectors as vec
from vireo.operators.features import text_features
from vireo.operators.joins import materialize
from vireo.operators.sampling import split_column
from vireo.functions.text import NUMERIC_FEATURES
from vireo.plans.registry import posts, query, table
from vireo.plans.sqlbits import features_sql, rnd, u32, unit
from vireo.session import scratch_dir
from vireo.sources import files
from vireo.sources import models as stored_models

# Fixed value: the reference's number of hashed slots.
N_HASH = 5000
METRICS = ["accuracy", "precision", "recall", "f1", "auc"]
# twin of the 80/20 hash split
TEST_SQL = f"(SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS label FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE {unit(u32('l.doc_id'))} >= 0.8)"


def _labelled(spark, sf):
    d = posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return d.withColumnRenamed("lang", "group")


def _prepared(spark, sf):
    pipe = vec.build_pipeline("text", "summary", "group", num_features=N_HASH, include_group=False)
    return md.prepare(_labelled(spark, sf), pipe, "doc_id", "quality", test_fraction=0.2, seed=42)


def _in_range(cols: list[str]):
    out = F.lit(True)
    for c in cols:
        out = out & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return out


def _train(name, est):
    def run(spark, sf):
        _, train, test = _prepared(spark, sf)
        _, metrics = md.train_all(train, test, {name: est()})
        facts = test.agg(F.count(F.lit(1)).alias("test_rows"), F.sum("label").cast("bigint").alias("test_positives"))
        return metrics.crossJoin(facts).select("model", "test_rows", "test_positives", _in_range(METRICS).alias("in_range"))  # one row each
    return run


for _name, _key, _est in (("train_lr", "logistic_regression", md.logistic), ("train_rf", "random_forest", md.random_forest),
                          ("train_dt", "decision_tree", md.decision_tree), ("train_gbt", "gbt", md.gbt)):
    query(_name, f"SELECT '{_key}' AS model, count(*) AS test_rows, CAST(sum(label) AS BIGINT) AS test_positives, true AS in_range FROM {TEST_SQL}")(_train(_key, _est))


def _grid_sql(grid: dict) -> str:
    rows = [f"({i}, '{', '.join(f'{n}={v}' for n, v in sorted(zip(grid, combo)))}')" for i, combo in enumerate(itertools.product(*grid.values()))]
    return f"SELECT combo, params, true AS in_range, true AS one_best FROM (VALUES {', '.join(rows)}) AS t(combo, params)"


def _tune(est, grid):
    def run(spark, sf):
        _, train, _ = _prepared(spark, sf)
        t = md.cv_table(md.tune(est(), grid, train, "doc_id", folds=3, parallelism=4))
        best = t.agg(F.count_if("best").alias("__best"))
        return t.crossJoin(best).select("combo", "params", _in_range(["mean_auc"]).alias("in_range"), (F.col("__best") == 1).alias("one_best"))
    return run


for _name, _key, _est in (("tune_lr", "logistic_regression", md.logistic), ("tune_rf", "random_forest", md.random_forest)):
    query(_name, _grid_sql(md.GRIDS["batch"][_key]))(_tune(_est, md.GRIDS["batch"][_key]))


@query("tune_gbt", _grid_sql(md.GRIDS["batch"]["gbt"]))
def q_tune_gbt(spark, sf):
    """G6 for GBT: all combinations of the published batch grid from half its fits."""
    _, train, _ = _prepared(spark, sf)
    t = md.tune_boosting(md.GRIDS["batch"]["gbt"], train, "doc_id", folds=3, parallelism=4)
    best = t.agg(F.count_if("best").alias("__best"))
    return t.crossJoin(best).select("combo", "params", _in_range(["mean_auc"]).alias("in_range"), (F.col("__best") == 1).alias("one_best"))


@query("cv_table", _grid_sql(md.GRIDS["batch"]["random_forest"]))
def q_cv_table(spark, sf):
    """G7 on the thirteen plain features, whose fits are quick."""
    f = text_features(_labelled(spark, sf), "text", "summary", mode="ref")
    d = vec.assembler(NUMERIC_FEATURES, "features").transform(f).select("doc_id", F.col("quality").cast("double").alias("label"), "features")
    t = md.cv_table(md.tune(md.random_forest(), md.GRIDS["batch"]["random_forest"], d, "doc_id", folds=3, parallelism=4))
    best = t.agg(F.count_if("best").alias("__best"))
    return t.crossJoin(best).select("combo", "params", _in_range(["mean_auc"]).alias("in_range"), (F.col("__best") == 1).alias("one_best"))


@query("importance", "SELECT 15 AS listed, 1.0::DOUBLE AS total, true AS named")
def q_importance(spark, sf):
    _, train, _ = _prepared(spark, sf)
    names = md.slot_names(train)
    train = md.cache_for_fit(train)
    rf = md.fit(md.random_forest(), train)
    train.unpersist()
    top = md.feature_importance(rf, names, k=15)
    whole = md.feature_importance(rf, names, k=len(names))
    total = whole.agg(F.round(F.sum("importance"), 6).alias("total"))
    return top.agg(F.count(F.lit(1)).cast("int").alias("listed"), F.min(F.col("name").isin(names)).alias("named")).crossJoin(total).select("listed", "total", "named")


# what each learner's summary lists: a value where the settings fix it, else the bounds it must keep
_SUMMARY_FACTS = [("logistic_regression", "iterations", None, 0, 100), ("logistic_regression", "final_objective", None, 0, 1),
                  ("decision_tree", "depth", None, 1, 10), ("decision_tree", "nodes", None, 3, 2047),
                  ("random_forest", "trees", 100, 100, 100), ("random_forest", "total_nodes", None, 100, 204_700),
                  ("gbt", "trees", 50, 50, 50), ("gbt", "total_nodes", None, 50, 3150)]


@query("model_summary", "SELECT model, item, CAST(value AS DOUBLE) AS value, true AS in_bounds FROM (VALUES "
       + ", ".join(f"('{m}', '{i}', {'NULL' if v is None else v})" for m, i, v, _, _ in _SUMMARY_FACTS) + ") AS t(model, item, value)")
def q_model_summary(spark, sf):
    """Every item of the four models' summaries; fitted values within the bounds that the settings give."""
    _, train, _ = _prepared(spark, sf)
    train = md.cache_for_fit(train)
    out = None
    for name, est in md.base_models().items():
        part = md.model_summary(name, md.fit(est, train))
        out = part if out is None else out.unionByName(part)
    train.unpersist()
    fixed, holds = F.lit(None).cast("double"), F.lit(False)
    for model, item, value, low, high in _SUMMARY_FACTS:
        here = (F.col("model") == model) & (F.col("item") == item)
        holds = holds | (here & F.col("value").between(low, high))
        if value is not None:
            fixed = F.when(here, F.col("value")).otherwise(fixed)
    return out.select("model", "item", fixed.alias("value"), holds.alias("in_bounds"))


def _fit_logistic(train):
    train = md.cache_for_fit(train)
    model = md.fit(md.logistic(), train)
    train.unpersist()
    return model


def _scored(spark, sf):
    _, train, test = _prepared(spark, sf)
    return md.score(_fit_logistic(train), test)


@query("score", f"SELECT doc_id, label, true AS consistent FROM {TEST_SQL}")
def q_score(spark, sf):
    """The positive score is the second probability, and the prediction follows it."""
    p = vector_to_array("probability")
    ok = (F.col("score") == p[1]) & (F.abs(p[0] + p[1] - 1) < 1e-9) & (F.col("prediction") == (F.col("score") > 0.5).cast("double"))
    return _scored(spark, sf).select("doc_id", "label", ok.alias("consistent"))


@query("predictions_roundtrip", f"SELECT doc_id, label, 2 AS classes FROM {TEST_SQL}")
def q_predictions_roundtrip(spark, sf):
    """A10: predictions written and read back."""
    path = scratch_dir(spark, f"predictions-{uuid.uuid4().hex[:12]}")
    files.write_predictions(_scored(spark, sf), path)
    return spark.read.parquet(path).select("doc_id", "label", F.size(vector_to_array("probability")).alias("classes"))


@query("model_roundtrip", f"SELECT doc_id, true AS same FROM {TEST_SQL}")
def q_model_roundtrip(spark, sf):
    """A saved and reloaded pipeline gives the same vectors."""
    model, _, test = _prepared(spark, sf)
    path = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    stored_models.save_model(model, path)
    rows = _labelled(spark, sf).where(split_column("doc_id", [0.8, 0.2], 42) == 1)  # the test part
    again = stored_models.load_pipeline(path).transform(rows).select("doc_id", F.col("features").alias("again"))
    return test.join(again, "doc_id").select("doc_id", (vector_to_array("features") == vector_to_array("again")).alias("same"))


_SLOTS = ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in NUMERIC_FEATURES)
_SCALED = ", ".join(rnd(f"CASE WHEN sd_{c} > 0 THEN {c} / sd_{c} ELSE 0.0 END", 5) + f" AS {c}" for c in NUMERIC_FEATURES)


@query("stages_scaled", f"""
WITH f AS (SELECT l.doc_id, {', '.join(features_sql("d.text", "split_part(d.text, chr(10), 1)", "ref"))} FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT {_SLOTS} FROM f WHERE {unit(u32("doc_id"))} < 0.8)
SELECT doc_id, {_SCALED} FROM f, s""")
def q_stages_scaled(spark, sf):
    """E8–E10 by value: the thirteen named slots of the fitted pipeline's vectors, scaled by the training part."""
    _, train, test = _prepared(spark, sf)
    both = train.unionByName(test).select("doc_id", vector_to_array("features").alias("x"))
    return both.select("doc_id", *[F.round(F.col("x")[i], 5).alias(c) for i, c in enumerate(NUMERIC_FEATURES)])


@query("mart_model", """
SELECT model, true AS in_range, true AS intervals_hold
FROM (VALUES ('decision_tree'), ('logistic_regression')) AS t(model)""")
def q_mart_model(spark, sf):
    """The model mart of two fitted models, written and read back; the best by F1 gives metrics and intervals."""
    from vireo.plans import marts

    made = marts.model_mart(spark, sf, {"logistic_regression": md.logistic(), "decision_tree": md.decision_tree()})
    path = scratch_dir(spark, f"mart-model-{uuid.uuid4().hex[:12]}")
    files.write_mart(made["comparison"], path)
    out = files.read_mart(spark, path)
    holds = made["intervals"].agg(F.min((F.col("lower") <= F.col("mean")) & (F.col("mean") <= F.col("upper"))).alias("intervals_hold"))
    return out.select("model", _in_range(METRICS).alias("in_range")).crossJoin(holds)  # one row


# ------------------------------------------------ the reference's main path

_GROUPS = "(SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)"
_ACTIVE = f"(SELECT d.doc_id, CASE WHEN g.n >= (SELECT quantile_disc(n, 0.8) FROM {_GROUPS}) THEN 1.0 ELSE 0.0 END AS label FROM documents d LEFT JOIN {_GROUPS} g ON d.lang = g.lang)"


@query("main_path", f"""
SELECT CAST(label AS DOUBLE) AS label, count(*) AS test_rows, true AS metrics_agree, true AS intervals_hold
FROM {_ACTIVE} WHERE {unit(u32("doc_id"))} >= 0.8 GROUP BY 1""")
def q_main_path(spark, sf):
    """Clean → activity label → features → split → fit → the model's own predictions → H1–H6.

    Per label: the test rows in the confusion cells; whether accuracy follows from the cells; and whether
    the bootstrap interval holds its mean and the stability runs their range.
    """
    d = lb.activity_label(posts(spark, sf), "lang", q=0.8, label_col="is_active")
    pipe = vec.build_pipeline("text", "summary", None, num_features=N_HASH)
    _, train, test = md.prepare(d, pipe, "doc_id", "is_active")
    scored = md.score(_fit_logistic(train), test).select("doc_id", "label", "prediction", "score")
    scored = materialize(scored)
    cells = ev.confusion(scored)
    direct = scored.agg(F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("direct"))
    agree = ev.class_metrics(scored).crossJoin(direct).crossJoin(ev.auc_roc(scored)).select(
        ((F.col("accuracy") == F.col("direct")) & F.coalesce(F.col("auc").between(0, 1), F.lit(True))).alias("metrics_agree"))
    ci = ev.bootstrap_ci(scored, "doc_id").agg(F.min((F.col("lower") <= F.col("mean")) & (F.col("mean") <= F.col("upper"))).alias("a"))
    runs = ev.stability(scored, "doc_id").agg(F.min(F.col("mean").between(0, 1) & (F.col("std") >= 0)).alias("b"))
    holds = ci.crossJoin(runs).select((F.col("a") & F.col("b")).alias("intervals_hold"))  # one row each
    return cells.groupBy("label").agg(F.sum("n").alias("test_rows")).crossJoin(agree).crossJoin(holds)
