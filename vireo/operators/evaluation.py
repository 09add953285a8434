"""Evaluation on any frame with a label, a prediction and a score.

Everything reduces the rows to tiny tables before anything global happens:

* class metrics need only the confusion cells (label x prediction counts);
* AUC and ROC need only one row per distinct score, and the running sums
  over scores use the range scheme in ``cumulative.py``;
* bootstrap and stability draw per-row Poisson / Bernoulli weights from the
  row's key hash for every replicate inside the scan, and sum them map-side
  into ``replicates x cells`` rows -- the rows are never copied or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.functions.hashing import key_hash64, poisson1_weight, with_stream_uniform
from vireo.functions.rows import rows_from
from vireo.operators.cumulative import below_sums
from vireo.operators.joins import materialize

ROUND = 6


# ----------------------------------------------------------------- cells

def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              weight: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """H1 long form: ``(by..., label, prediction, n)``."""
    by = by or []
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
             .agg(w.alias("n"))


def confusion_wide(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   positive=1) -> DataFrame:
    """H1 wide form: one row ``(tp, tn, fp, fn)`` for the positive class."""
    y, p = F.col(label) == positive, F.col(prediction) == positive
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"),
                  F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))


def metrics_from_cells(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H2 from cells ``(by..., label, prediction, n)``: accuracy, weighted
    precision, weighted recall, weighted F1 (0 for an empty class)."""
    by = by or []
    n = F.col("n").cast("double")
    # each cell counts once for its label's class (a, tp) and once for its
    # prediction's class (h): two rows from one, without a union
    per_class = rows_from(cells, [
        {"cls": F.col("label").cast("double"), "a": n, "h": F.lit(0.0),
         "tp": F.when(F.col("label") == F.col("prediction"), n).otherwise(0.0)},
        {"cls": F.col("prediction").cast("double"), "a": F.lit(0.0), "h": n, "tp": F.lit(0.0)},
    ], keep=by).groupBy(*by, "cls").agg(F.sum("a").alias("a"), F.sum("h").alias("h"), F.sum("tp").alias("tp"))
    total = F.sum("a").over(Window.partitionBy(*by)) if by else F.sum("a").over(Window.partitionBy())
    per_class = per_class.withColumn("N", total)
    share = F.col("a") / F.col("N")
    prec = F.when(F.col("h") > 0, F.col("tp") / F.col("h")).otherwise(0.0)
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("a") + F.col("h"))).otherwise(0.0)
    rec = F.when(F.col("a") > 0, F.col("tp") / F.col("a")).otherwise(0.0)
    return per_class.groupBy(*by).agg(
        (F.sum("tp") / F.first("N")).alias("accuracy"),
        F.sum(share * prec).alias("precision"),
        F.sum(share * rec).alias("recall"),
        F.sum(share * f1).alias("f1"))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """H2: one row of weighted metrics."""
    m = metrics_from_cells(confusion(df, label, prediction))
    return m.select(*[F.round(c, ROUND).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


# ------------------------------------------------------------- ranking

def score_table(df: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None) -> DataFrame:
    """One row per distinct score (and group): positives ``p`` and negatives ``n``.

    Rows without a label or a score can't be ranked and take no part; ``unranked`` counts them.
    """
    y = F.col(label).cast("double")
    ranked = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return ranked.groupBy(*(by or []), F.col(score).cast("double").alias("s")).agg(F.sum(y).alias("p"), F.sum(1.0 - y).alias("n"))


def unranked(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(rows, unranked)``: how many rows lack a label or a score."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label).isNull() | F.col(score).isNull()).alias("unranked"))


def _auc(table: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., auc)`` of a stored score table: sum_s p(s) * (negatives below s + n(s)/2) / (P * N)."""
    t = below_sums(table, "s", ["n"], by)
    agg = t.groupBy(*by).agg(F.sum(F.col("p") * (F.col("below_n") + F.lit(0.5) * F.col("n"))).alias("num"),
                             F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    return agg.select(*by, (F.col("num") / F.nullif(F.col("all_p") * F.col("all_n"), F.lit(0.0))).alias("auc"))


def auc_roc(df: DataFrame, label: str = "label", score: str = "score", digits: int | None = ROUND) -> DataFrame:
    """H3: exact area under ROC (ties count half), ``(auc)``; the input is read once."""
    auc = _auc(materialize(score_table(df, label, score)), [])
    return auc if digits is None else auc.select(F.round("auc", digits).alias("auc"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """H4: ``(threshold, fpr, tpr)`` for "score >= threshold" at every
    distinct score, plus the (inf, 0, 0) start point; the input is read once."""
    table = materialize(score_table(df, label, score))
    t = below_sums(table, "s", ["p", "n"])
    totals = table.agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))  # one row
    share = lambda total, below: F.round((F.col(total) - F.col(below)) / F.nullif(F.col(total), F.lit(0.0)), ROUND)
    pts = t.crossJoin(totals).select(F.col("s").alias("threshold"), share("all_n", "below_n").alias("fpr"), share("all_p", "below_p").alias("tpr"))
    start = totals.where(F.col("all_p").isNotNull()).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def positive_score(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    from pyspark.ml.functions import vector_to_array
    return df.withColumn(out, vector_to_array(F.col(probability))[1])


# ------------------------------------------------------- resampling

def _replicate_cells(df: DataFrame, key: str, label: str, prediction: str, replicates: int,
                     weight_of, seed: int, stream_offset: int) -> DataFrame:
    h = key_hash64(F.col(key), seed)
    x = df.select(h.alias("__h"), F.col(label).alias("label"), F.col(prediction).alias("prediction"))
    x = x.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    # the uniform is a column of its own, so the weight's table look-up does not repeat the mixing
    x = with_stream_uniform(x, "__h", F.col("rep") + F.lit(stream_offset), "__u")
    return x.groupBy("rep", "label", "prediction").agg(F.sum(weight_of(F.col("__u"))).alias("n"))


def bootstrap_ci(df: DataFrame, key: str, label: str = "label", prediction: str = "prediction",
                 replicates: int = 100, ci: float = 0.95, seed: int = 42) -> DataFrame:
    """H5: ``(metric, point, mean, lower, upper)`` for accuracy and weighted F1.

    Poisson(1) bootstrap: each row gets an independent Poisson(1) weight per
    replicate, a pure function of (seed, key, replicate), summed map-side into
    cells.  A replicate's size equals the row count only on average.
    """
    cells = _replicate_cells(df, key, label, prediction, replicates, poisson1_weight, seed, 0)
    per_rep = metrics_from_cells(cells, ["rep"])
    lo, hi = (1.0 - ci) / 2.0, 1.0 - (1.0 - ci) / 2.0
    point = metrics_from_cells(confusion(df, label, prediction))
    ms = ("accuracy", "f1")
    agg = per_rep.agg(*[a for m in ms for a in (
        F.avg(m).alias(f"{m}_mean"), F.percentile(m, F.lit(lo)).alias(f"{m}_lower"),
        F.percentile(m, F.lit(hi)).alias(f"{m}_upper"))])
    return rows_from(agg, [{"metric": F.lit(m), "point": F.round(point.select(m).scalar(), ROUND),
                            "mean": F.round(f"{m}_mean", ROUND), "lower": F.round(f"{m}_lower", ROUND),
                            "upper": F.round(f"{m}_upper", ROUND)} for m in ms])


def bootstrap_replicates(df: DataFrame, key: str, label: str = "label", prediction: str = "prediction",
                         replicates: int = 100, seed: int = 42) -> DataFrame:
    """Per-replicate metrics ``(rep, accuracy, precision, recall, f1, size)``."""
    cells = _replicate_cells(df, key, label, prediction, replicates, poisson1_weight, seed, 0)
    m = metrics_from_cells(cells, ["rep"])
    size = cells.groupBy("rep").agg(F.sum("n").alias("size"))
    return m.join(size, "rep")


def stability(df: DataFrame, key: str, label: str = "label", prediction: str = "prediction",
              runs: int = 10, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """H6: metrics on ``runs`` subsamples of ``fraction``; mean and
    population std per metric: ``(metric, mean, std)``."""
    def keep(u):
        return F.when(u < F.lit(float(fraction)), F.lit(1)).otherwise(F.lit(0))
    cells = _replicate_cells(df, key, label, prediction, runs, keep, seed, 1_000_000)
    per_run = metrics_from_cells(cells, ["rep"])
    ms = ("accuracy", "precision", "f1")
    agg = per_run.agg(*[a for m in ms for a in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))])
    return rows_from(agg, [{"metric": F.lit(m), "mean": F.round(f"{m}_mean", ROUND),
                            "std": F.round(f"{m}_std", ROUND)} for m in ms])


def stability_grade(stab: DataFrame, metric: str = "f1") -> DataFrame:
    """H7: HIGH when the metric's std < 0.005, MODERATE when < 0.01, else LOW."""
    return stab.where(F.col("metric") == metric).select(
        "metric", "std",
        F.when(F.col("std") < 0.005, "HIGH").when(F.col("std") < 0.01, "MODERATE").otherwise("LOW").alias("grade"))


# --------------------------------------------------------- comparisons

def compare_models_long(df: DataFrame, model: str = "model", label: str = "label", prediction: str = "prediction",
                        score: str = "score") -> DataFrame:
    """H8 on rows tagged with their model: ``(model, accuracy, precision, recall, f1, auc)`` at 4 dp.

    One pass reduces the rows to counts per (model, score, label, prediction); the cells and the
    score table of all models come from that stored table.
    """
    counts = materialize(df.groupBy(F.col(model).alias("model"), F.col(score).cast("double").alias("score"), F.col(label).alias("label"),
                                    F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("w")))
    cells = counts.groupBy("model", "label", "prediction").agg(F.sum("w").alias("n"))
    y = F.col("label").cast("double")
    scores = (counts.where(F.col("label").isNotNull() & F.col("score").isNotNull()).groupBy("model", F.col("score").alias("s"))
              .agg(F.sum(y * F.col("w")).alias("p"), F.sum((1.0 - y) * F.col("w")).alias("n")))
    names = ["accuracy", "precision", "recall", "f1", "auc"]
    both = metrics_from_cells(cells, ["model"]).join(_auc(scores, ["model"]), "model", "left")
    return both.select("model", *[F.round(c, 4).alias(c) for c in names])


def model_metrics(df: DataFrame, model: str, label: str = "label", prediction: str = "prediction",
                  score: str = "score") -> DataFrame:
    """One row ``(model, accuracy, precision, recall, f1, auc)`` at 4 dp."""
    return compare_models_long(df.withColumn("__model", F.lit(model)), "__model", label, prediction, score)


def compare_models(frames: dict[str, DataFrame], label: str = "label", prediction: str = "prediction",
                   score: str = "score") -> DataFrame:
    """H8: one row per model, each given as a frame of its own; all are evaluated in one pass."""
    long = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("__model"), F.col(label).cast("double").alias("label"),
                         F.col(prediction).cast("double").alias("prediction"), F.col(score).cast("double").alias("score"))
        long = part if long is None else long.unionByName(part)
    return compare_models_long(long, "__model")


def best_model(table: DataFrame, metric: str = "f1", model_col: str = "model") -> DataFrame:
    """H9: the row with the highest ``metric``; ties by model name."""
    return table.orderBy(F.desc(metric), F.asc(model_col)).limit(1)


def metrics_long(table: DataFrame, id_cols: list[str] | None = None,
                 metrics: list[str] | None = None) -> DataFrame:
    """Wide metric rows -> ``(model, metric, score)``."""
    id_cols = id_cols or ["model"]
    metrics = metrics or [c for c in table.columns if c not in id_cols]
    cast = table.select(*id_cols, *[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot(id_cols, metrics, "metric", "score")


def framework_union(a: DataFrame, b: DataFrame, name_a: str = "spark", name_b: str = "other",
                    rename_b: dict[str, str] | None = None) -> DataFrame:
    """Stack two result tables whose columns differ; align names of
    ``b`` with ``rename_b`` and tag each row with its framework."""
    for old, new in (rename_b or {}).items():
        b = b.withColumnRenamed(old, new)
    return (a.withColumn("framework", F.lit(name_a))
             .unionByName(b.withColumn("framework", F.lit(name_b)), allowMissingColumns=True))


def framework_pairs(a: DataFrame, b: DataFrame, cols: list[str], model_col: str = "model",
                    suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Side-by-side metrics per model, joined on the model name (not
    zipped by position as the original did)."""
    sa = a.select(model_col, *[F.col(c).alias(c + suffixes[0]) for c in cols])
    sb = b.select(model_col, *[F.col(c).alias(c + suffixes[1]) for c in cols])
    return sa.join(sb, model_col)
