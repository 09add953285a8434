"""Queries for evaluation on ``labels ⋈ documents``:
label = quality, score = n_chars, prediction = n_chars > 1000."""

from __future__ import annotations

from pyspark.sql import functions as F

from vireo.functions.hashing import poisson1_cdf
from vireo.operators import evaluation as ev
from vireo.operators import scaling as sc
from vireo.operators.difference import table_difference
from vireo.operators.joins import materialize
from vireo.plans.registry import SCORED_SQL, query, scored_labels, table
from vireo.plans.sqlbits import rnd, stream_columns, u32, u64, unit


def metrics_sql(cells: str, by: list[str]) -> str:
    """CTEs ``pc, pcn, m`` computing weighted metrics from a cells CTE."""
    g = ", ".join(by) + ", " if by else ""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    gb = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""pc AS (SELECT {g}cls, sum(a) AS a, sum(h) AS h, sum(tp) AS tp FROM (
    SELECT {g}CAST(label AS DOUBLE) AS cls, CAST(n AS DOUBLE) AS a, 0.0 AS h,
           CASE WHEN label = prediction THEN CAST(n AS DOUBLE) ELSE 0.0 END AS tp FROM {cells}
    UNION ALL
    SELECT {g}CAST(prediction AS DOUBLE), 0.0, CAST(n AS DOUBLE), 0.0 FROM {cells}) GROUP BY {g}cls),
pcn AS (SELECT *, sum(a) OVER ({part}) AS "N" FROM pc),
m AS (SELECT {g}sum(tp) / max("N") AS accuracy,
        sum(a / "N" * CASE WHEN h > 0 THEN tp / h ELSE 0.0 END) AS precision,
        sum(a / "N" * CASE WHEN a > 0 THEN tp / a ELSE 0.0 END) AS recall,
        sum(a / "N" * CASE WHEN tp > 0 THEN 2.0 * tp / (a + h) ELSE 0.0 END) AS f1
      FROM pcn {gb})"""


def auc_sql(scored: str) -> str:
    return f"""(SELECT sum(p * (below + 0.5 * n)) / nullif(sum(p) * sum(n), 0.0) FROM (
  SELECT s, p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS below
  FROM (SELECT CAST(score AS DOUBLE) AS s, sum(CAST(label AS DOUBLE)) AS p, sum(1.0 - label) AS n
        FROM {scored} GROUP BY 1)))"""


@query("confusion", f"SELECT label, prediction, count(*) AS n FROM {SCORED_SQL} GROUP BY label, prediction")
def q_confusion(spark, sf):
    return ev.confusion(scored_labels(spark, sf))


@query("confusion_wide", f"""
SELECT count_if(label = 1 AND prediction = 1)::BIGINT AS tp, count_if(label <> 1 AND prediction <> 1)::BIGINT AS tn,
       count_if(label <> 1 AND prediction = 1)::BIGINT AS fp, count_if(label = 1 AND prediction <> 1)::BIGINT AS fn
FROM {SCORED_SQL}""")
def q_confusion_wide(spark, sf):
    return ev.confusion_wide(scored_labels(spark, sf))


@query("class_metrics", f"""
WITH cells AS (SELECT label, prediction, count(*) AS n FROM {SCORED_SQL} GROUP BY ALL),
{metrics_sql("cells", [])}
SELECT {rnd("accuracy")} AS accuracy, {rnd("precision")} AS precision, {rnd("recall")} AS recall,
       {rnd("f1")} AS f1 FROM m""")
def q_class_metrics(spark, sf):
    return ev.class_metrics(scored_labels(spark, sf))


@query("auc_roc", f"SELECT {rnd(auc_sql(SCORED_SQL))} AS auc")
def q_auc_roc(spark, sf):
    return ev.auc_roc(scored_labels(spark, sf))


@query("roc_points", f"""
WITH st AS (SELECT CAST(score AS DOUBLE) AS s, sum(CAST(label AS DOUBLE)) AS p, sum(1.0 - label) AS n
            FROM {SCORED_SQL} GROUP BY 1),
c AS (SELECT s, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS fp,
             sum(p) OVER () AS "P", sum(n) OVER () AS "N" FROM st)
SELECT s AS threshold, {rnd('fp / nullif("N", 0.0)')} AS fpr, {rnd('tp / nullif("P", 0.0)')} AS tpr FROM c
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_points(spark, sf):
    return ev.roc_points(scored_labels(spark, sf))


def _poisson_case(u: str) -> str:
    cdf = poisson1_cdf()
    whens = " ".join(f"WHEN {u} < {c!r}::DOUBLE THEN {k}" for k, c in enumerate(cdf))
    return f"CASE {whens} ELSE {len(cdf)} END"


def _bootstrap_sql(reps: int = 100, ci: float = 0.95) -> str:
    lo, hi = (1 - ci) / 2, 1 - (1 - ci) / 2
    hi_, lo_ = u64("doc_id")
    parts = []
    for m in ("accuracy", "f1"):
        parts.append(f"""SELECT '{m}' AS metric, (SELECT {rnd(m)} FROM m0) AS point, {rnd(f"avg({m})")} AS mean,
  {rnd(f"quantile_cont({m}, {lo!r})")} AS lower, {rnd(f"quantile_cont({m}, {hi!r})")} AS upper FROM m""")
    m0 = metrics_sql("cells0", []).replace("pc AS", "pc0 AS").replace("FROM pc)", "FROM pc0)") \
        .replace("pcn AS", "pcn0 AS").replace("FROM pcn ", "FROM pcn0 ").replace("m AS (", "m0 AS (")
    return f"""WITH x AS (SELECT {hi_} AS hi, {lo_} AS lo, label, prediction FROM {SCORED_SQL}),
r AS (SELECT hi, lo, label, prediction, unnest(range(1, {reps + 1})) AS rep FROM x),
cells AS (SELECT rep, label, prediction, sum({_poisson_case("u")}) AS n FROM {stream_columns("r", "rep", "rep, label, prediction")} GROUP BY ALL),
cells0 AS (SELECT label, prediction, count(*) AS n FROM x GROUP BY ALL),
{m0},
{metrics_sql("cells", ["rep"])}
""" + "\nUNION ALL\n".join(parts)


@query("bootstrap_ci", _bootstrap_sql())
def q_bootstrap_ci(spark, sf):
    return ev.bootstrap_ci(scored_labels(spark, sf), "doc_id", replicates=100, ci=0.95, seed=42)


def _stability_sql(runs: int = 10, frac: float = 0.8) -> str:
    hi_, lo_ = u64("doc_id")
    parts = [f"""SELECT '{m}' AS metric, {rnd(f"avg({m})")} AS mean, {rnd(f"stddev_pop({m})")} AS std FROM m"""
             for m in ("accuracy", "precision", "f1")]
    return f"""WITH x AS (SELECT {hi_} AS hi, {lo_} AS lo, label, prediction FROM {SCORED_SQL}),
r AS (SELECT hi, lo, label, prediction, unnest(range(1, {runs + 1})) AS rep FROM x),
cells AS (SELECT rep, label, prediction, sum(CASE WHEN u < {frac!r} THEN 1 ELSE 0 END) AS n
          FROM {stream_columns("r", "rep + 1000000", "rep, label, prediction")} GROUP BY ALL),
{metrics_sql("cells", ["rep"])}
""" + "\nUNION ALL\n".join(parts)


@query("stability", _stability_sql())
def q_stability(spark, sf):
    return ev.stability(scored_labels(spark, sf), "doc_id", runs=10, fraction=0.8, seed=42)


@query("stability_grade", f"""
WITH s AS ({_stability_sql()})
SELECT metric, std, CASE WHEN std < 0.005 THEN 'HIGH' WHEN std < 0.01 THEN 'MODERATE' ELSE 'LOW' END AS grade
FROM s WHERE metric = 'f1'""")
def q_stability_grade(spark, sf):
    return ev.stability_grade(ev.stability(scored_labels(spark, sf), "doc_id", runs=10, fraction=0.8, seed=42))


# ------------------------------------------------ two rules as two models

# characters above (long_text) or up to which (short_text) a rule says yes, in two frameworks
_RULES = {"first": (1000, 600), "second": (2500, 300)}


def _models_sql(rules: str) -> str:
    above, upto = _RULES[rules]
    return ("(SELECT l.doc_id, l.quality AS label, 'long_text' AS model, CAST(d.n_chars AS DOUBLE) AS score, "
            f"CAST(d.n_chars > {above} AS INTEGER) AS prediction FROM labels l JOIN documents d ON l.doc_id = d.doc_id "
            "UNION ALL SELECT l.doc_id, l.quality, 'short_text', -CAST(d.n_chars AS DOUBLE), "
            f"CAST(d.n_chars <= {upto} AS INTEGER) FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")


def _model_rows(spark, sf, rules: str = "first"):
    """Both rules on every row, long form, from one read."""
    above, upto = _RULES[rules]
    s = scored_labels(spark, sf)
    both = F.array(F.struct(F.lit("long_text").alias("model"), F.col("score").alias("score"), (F.col("score") > above).cast("int").alias("prediction")),
                   F.struct(F.lit("short_text").alias("model"), (-F.col("score")).alias("score"), (F.col("score") <= upto).cast("int").alias("prediction")))
    return s.select("doc_id", "label", F.explode(both).alias("r")).select("doc_id", "label", "r.*")


def _compared(spark, sf):
    return ev.compare_models_long(_model_rows(spark, sf))


def _compare_sql(rules: str = "first") -> str:
    parts = []
    for name in ("long_text", "short_text"):
        sub = f"(SELECT * FROM {_models_sql(rules)} WHERE model = '{name}')"
        parts.append(f"""(WITH cells AS (SELECT label, prediction, count(*) AS n FROM {sub} GROUP BY ALL),
{metrics_sql("cells", [])}
SELECT '{name}' AS model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision,
       round(recall, 4) AS recall, round(f1, 4) AS f1, round({auc_sql(sub)}, 4) AS auc FROM m)""")
    return "\nUNION ALL\n".join(parts)


_COMPARE = _compare_sql()


@query("compare_models", _COMPARE)
def q_compare_models(spark, sf):
    return _compared(spark, sf)


@query("best_model", f"SELECT * FROM ({_COMPARE}) ORDER BY f1 DESC, model LIMIT 1")
def q_best_model(spark, sf):
    return ev.best_model(_compared(spark, sf), "f1")


@query("metrics_long", f"""
SELECT model, metric, score FROM (UNPIVOT ({_COMPARE}) ON accuracy, precision, recall, f1, auc
  INTO NAME metric VALUE score)""")
def q_metrics_long(spark, sf):
    return ev.metrics_long(_compared(spark, sf), ["model"])


@query("framework_union", f"""
SELECT model, accuracy, precision, recall, f1, auc, 'spark' AS framework FROM ({_COMPARE})
UNION ALL
SELECT model, accuracy, NULL, NULL, NULL, auc, 'other' FROM ({_COMPARE})""")
def q_framework_union(spark, sf):
    cmp = _compared(spark, sf)
    other = cmp.select(F.col("model").alias("Model"), F.col("accuracy").alias("Accuracy"),
                       F.col("auc").alias("AUC-ROC"))
    return ev.framework_union(cmp, other, "spark", "other",
                              rename_b={"Model": "model", "Accuracy": "accuracy", "AUC-ROC": "auc"})


@query("framework_pairs", f"""
SELECT a.model, a.accuracy AS accuracy_a, a.auc AS auc_a, b.accuracy AS accuracy_b, b.auc AS auc_b
FROM ({_COMPARE}) a JOIN ({_compare_sql("second")}) b ON a.model = b.model""")
def q_framework_pairs(spark, sf):
    """Two frameworks' results over all rows side by side: the rules with one pair of limits and with another."""
    a, b = (materialize(ev.compare_models_long(_model_rows(spark, sf, rules))) for rules in ("first", "second"))
    return ev.framework_pairs(a, b, ["accuracy", "auc"])


_SIZES = [0.25, 0.5, 0.75, 1.0]


@query("size_impact_auc", " UNION ALL ".join(
    f"SELECT CAST({f!r} AS DOUBLE) AS data_fraction, (SELECT count(*) FROM {SCORED_SQL} WHERE {unit(u32('doc_id'))} < {f!r}) AS \"rows\", "
    f"{rnd(auc_sql('(SELECT * FROM ' + SCORED_SQL + ' WHERE ' + unit(u32('doc_id')) + f' < {f!r})'))} AS auc" for f in _SIZES))
def q_size_impact_auc(spark, sf):
    return sc.size_scores(scored_labels(spark, sf), "doc_id", _SIZES)


# two prediction tables over all documents: by length, and by length and source, each leaving out its own rows without a value
_RULE_A = "SELECT doc_id, CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS prediction, round(n_chars / 1000.0, 3) AS score FROM documents WHERE lang <> 'de'"
_RULE_B = """SELECT doc_id, CASE WHEN n_chars >= 900 OR lang = 'fr' THEN 1 ELSE 0 END AS prediction, round(n_chars / 1000.0, 3) AS score
FROM documents WHERE lang <> 'es'"""


@query("table_difference", f"""
WITH a AS ({_RULE_A}), b AS ({_RULE_B})
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
       CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS status,
       CAST(CASE WHEN a.doc_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_a, CAST(CASE WHEN b.doc_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_b
FROM a FULL JOIN b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.prediction <> b.prediction OR a.score <> b.score""")
def q_table_difference(spark, sf):
    """Added, removed and changed rows of two prediction tables."""
    d = table(spark, sf, "documents")
    score = F.round(F.col("n_chars") / 1000.0, 3).alias("score")
    a = d.where("lang <> 'de'").select("doc_id", F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("prediction"), score)
    b = d.where("lang <> 'es'").select("doc_id", F.when((F.col("n_chars") >= 900) | (F.col("lang") == "fr"), 1).otherwise(0).alias("prediction"), score)
    return table_difference(a, b, ["doc_id"])
