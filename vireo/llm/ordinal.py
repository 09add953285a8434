"""Operator 5: toxicity severity by cumulative-link ordinal regression.

The model has one weight vector for all grades and ordered thresholds: P(grade <= g) = sigmoid(theta_g - w.x).
x holds the logs of 1 + counts of selected text features: words (A-Z lower-cased), and words' first four and
five bytes, which cover inflected and punctuated forms.  The output is the expected severity
sum over g of P(grade > g), the probability of any toxicity, and the most probable grade.

Grades: ``labels`` marks texts as toxic or not.  A marker is a word feature that training texts use at least
``MARKER_ODDS`` times as often when toxic; grade 0 are the texts not marked toxic, and toxic texts are graded 1,
2, 3 by the terciles of their number of different markers.

What is fitted on a sample: features, grades and weights, on at most ``SAMPLE_PER_CLASS`` labelled texts of each
class, chosen by a hash of the id; an id that repeats gives one text, that of the smallest digest.  The features kept are the ``FEATURES`` with the largest likelihood ratio.
Rows weigh so that the classes stand as in all labels.  Scoring covers every row's whole text.

Defined cases: null text is empty; an empty text scores by the thresholds alone; repeated labels of one id count
as one (the larger value); without labels of both classes every text gets the share of toxic labels (0 without
labels); repeated rows are scored alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import byte_slices, id_remainder, one_text, stored, word_hashes

SAMPLE_PER_CLASS = 5000
FEATURES, LEAST_TEXTS = 4096, 3
MARKER_ODDS = 20.0
GRADES = 3
RIDGE = 1.0
TOXIC = 0.5
PREFIXES = (4, 5)


class Model:
    """Sorted feature hashes, their weights, and the thresholds."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, share: float):
        self.features, self.weights, self.thresholds, self.share = features, weights, thresholds, share


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text number, feature hash) of every word and word start; words come first."""
    hashes, counts, *starts = word_hashes(column, lower=True, prefixes=PREFIXES)
    text = np.repeat(np.arange(len(counts)), counts)
    return np.tile(text, 1 + len(starts)), np.concatenate([hashes, *starts]), len(hashes)


def counted_features(column: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, feature) with counts, and whether the feature is a whole word; only of ``chosen`` if given."""
    text, feature, words = text_features(column)
    whole = np.arange(len(feature)) < words
    if chosen is not None:
        at = np.minimum(np.searchsorted(chosen, feature), max(len(chosen) - 1, 0))
        known = chosen[at] == feature if len(chosen) else np.zeros(len(feature), bool)
        text, feature, whole = text[known], at[known], whole[known]
    order = np.lexsort((feature, text))
    text, feature, whole = text[order], feature[order], whole[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    first = np.flatnonzero(new)
    return text[first], feature[first], np.diff(np.append(first, len(text))), whole[first]


def _select(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, whether each is a word, odds): the most telling ones by likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in byte_slices(whole_batch, "text", 4 << 20):
                text, feature, _, whole = counted_features(batch.column("text"))
                toxic = batch.column("y").to_numpy().astype(np.int64)[text]
                keys, at = np.unique(feature, return_inverse=True)
                a, n = np.bincount(at, toxic, len(keys)).astype(np.int64), np.bincount(at, minlength=len(keys))
                words = np.bincount(at, whole, len(keys)) > 0
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(words), pa.array(a), pa.array(n - a)], ["feature", "word", "toxic", "clean"])

    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    nt, nc = sizes[1], sizes[0]
    seen = (sample.select("text", "y").mapInArrow(count, "feature long, word boolean, toxic long, clean long")
            .groupBy("feature").agg(F.max("word").alias("word"), F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(F.col("a") + F.col("b") >= LEAST_TEXTS))
    a, b = F.col("a"), F.col("b")
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    n, present = nt + nc, a + b
    ratio = term(a, present * nt / n) + term(b, present * nc / n) + term(nt - a, (n - present) * nt / n) + term(nc - b, (n - present) * nc / n)
    odds = ((a + 0.5) / (nt + 1.0)) / ((b + 0.5) / (nc + 1.0))
    top = seen.select("feature", "word", ratio.alias("ratio"), odds.alias("odds")).orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()
    table = sorted((int(r["feature"]) & (1 << 64) - 1, r["word"], r["odds"]) for r in top)
    return np.array([x[0] for x in table], np.uint64), np.array([x[1] for x in table], bool), np.array([x[2] for x in table])


def grade_edges(markers: np.ndarray) -> np.ndarray:
    """Marker counts above which a toxic text is of grade 2, 3 ...: its terciles, each once."""
    return np.unique(np.quantile(markers, np.arange(1, GRADES) / GRADES, method="lower")) if len(markers) else np.zeros(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, weight: np.ndarray, features: int, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the penalised cumulative-link model, by Adam on the full sample.

    ``rows, cols, values`` are the sparse design.  Thresholds are a first one and positive gaps, so they stay ordered.
    """
    n, top = len(grade), int(grade.max())
    w, theta = np.zeros(features), np.zeros(top)
    share = np.array([(weight * (grade <= g)).sum() / weight.sum() for g in range(top)]).clip(1e-4, 1 - 1e-4)
    cut = np.log(share / (1 - share))
    theta[0] = cut[0]
    theta[1:] = np.log(np.maximum(np.diff(cut), 0.05))
    p = np.concatenate([w, theta])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, theta = p[:features], p[features:]
        gaps = np.exp(theta[1:])
        cut = np.concatenate([[-np.inf, theta[0]], theta[0] + np.cumsum(gaps), [np.inf]])
        score = np.bincount(rows, values * w[cols], n)
        upper, lower = _sigmoid(cut[grade + 1] - score), _sigmoid(cut[grade] - score)
        mass = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) * weight / mass, lower * (1 - lower) * weight / mass
        # derivatives of -log likelihood
        by_cut = np.bincount(grade + 1, -du, top + 2) + np.bincount(grade, dl, top + 2)
        inner = by_cut[1:top + 1]
        d_theta = np.concatenate([[inner.sum()], gaps * np.cumsum(inner[::-1])[::-1][1:]])
        d_w = np.bincount(cols, values * (du - dl)[rows], features) + RIDGE * w
        g = np.concatenate([d_w, d_theta])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.1 if step <= steps // 2 else 0.02
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    theta = p[features:]
    return p[:features], np.concatenate([[theta[0]], theta[0] + np.cumsum(np.exp(theta[1:]))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of the labelled rows given."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    constant = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), share)
    if len(sizes) < 2:
        return constant
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CLASS)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 x SAMPLE_PER_CLASS ids, so their broadcast is bounded
    sample = stored(one_text(docs, chosen, id_col, text_col).select("text", "y"), "toxicity-sample")
    if sample.select("y").distinct().count() < 2:
        return constant
    features, word, odds = _select(sample)

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in byte_slices(whole_batch, "text", 4 << 20):
                text, at, count, _ = counted_features(batch.column("text"), features)
                sizes = np.bincount(text, minlength=batch.num_rows)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32)))], ["y", "at", "n"])

    rows = sorted((r["y"], r["at"], r["n"]) for r in sample.mapInArrow(design, "y int, at array<int>, n array<int>").collect())
    y = np.array([r[0] for r in rows])
    lengths = np.array([len(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    col = np.array([c for r in rows for c in r[1]], dtype=np.int64)
    count = np.array([c for r in rows for c in r[2]], dtype=np.float64)
    marks = np.bincount(row, (word & (odds >= MARKER_ODDS))[col], len(rows))
    grade = np.where(y == 1, 1 + np.searchsorted(grade_edges(marks[y == 1]), marks, "left"), 0)
    grade = np.unique(grade, return_inverse=True)[1]  # without a gap, should a tercile be empty
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    weights, thresholds = fit_ordinal(row, col, np.log1p(count), grade, weight, len(features))
    return Model(features, weights, thresholds, share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, severity (expected grade), p_toxic, grade (most probable)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", 4 << 20):
                n = batch.num_rows
                if len(model.thresholds):
                    text, at, count, _ = counted_features(batch.column("text"), model.features)
                    x = np.bincount(text, np.log1p(count) * model.weights[at], n) if len(text) else np.zeros(n)
                    above = _sigmoid(x[:, None] - model.thresholds[None, :])
                else:
                    above = np.full((n, 1), model.share)
                each = np.concatenate([np.ones((n, 1)), above], axis=1) - np.concatenate([above, np.zeros((n, 1))], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(each.argmax(axis=1).astype(np.int32))], ["id", "severity", "p_toxic", "grade"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(scored, f"id {id_type}, severity double, p_toxic double, grade int").withColumnRenamed("id", id_col)


def toxicity_severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every text's severity; fitted on labelled rows whose crc32 remainder by 4 is not 2, the rest are held out."""
    model = fit(docs, labels.where(id_remainder("doc_id", 4) != 2))
    return score(docs, model).select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "severity", "p_toxic", "grade",
                                     F.when(F.col("p_toxic") >= TOXIC, 1).otherwise(0).alias("predicted"))
