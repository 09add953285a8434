"""Operator 8: compression classifier for quality.

Two zstandard dictionaries are trained, one on good and one on bad labelled
text.  A text is cut into blocks of ``BLOCK`` bytes, each compressed three
times: without a dictionary, with the good and with the bad one, so the
dictionaries weigh as much at the end of a long text as at its start.  The
normalised difference (bad - good) / plain and the plain ratio, both sums
over all blocks, go through a logistic calibration fitted on labelled rows.

What is fitted on a sample: the dictionaries, on at most ``SAMPLE_DOCS`` labelled
texts of each class; of the pooled blocks of their whole texts, equal ones counted
once, the ``SAMPLE_BLOCKS`` of smallest hash (all, if fewer); the calibration, on at
most ``CALIBRATION_DOCS`` other labelled texts per class.  Both samples of texts go by a hash of
the id; an id that repeats gives one text, that of the smallest digest.
Scoring covers every row's whole text.

Defined cases: null text is empty; an empty text compresses to nothing and gets
the calibrated score of a zero difference; where one class has no labelled text
the score is the share of good labels (0.5 without labels); repeated labels of
one id count as one (the smaller value); repeated rows are scored alike; extra
columns are not read; ``score`` replaces a column that has the name of its result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import id_remainder, one_text, stored, text_buffers

BLOCK = 2048
LEVEL = 3
DICTIONARY_BYTES = 96 << 10
SAMPLE_DOCS, SAMPLE_BLOCKS, CALIBRATION_DOCS = 1200, 8192, 1200
ACCEPT = 0.7


class Model:
    """Dictionaries and calibration; small enough to ship with every task."""

    def __init__(self, good: bytes, bad: bytes, weights: list[float], prior: float):
        self.good, self.bad, self.weights, self.prior = good, bad, weights, prior


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    plain = zstandard.ZstdCompressor(**options)
    made = [plain]
    for raw in (good, bad):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=d, **options))
    return made


def _sizes(text: memoryview, compressors: list) -> tuple[int, int, int]:
    totals = [0, 0, 0]
    for at in range(0, len(text), BLOCK):
        block = text[at:at + BLOCK]
        for i, c in enumerate(compressors):
            totals[i] += len(c.compress(block))
    return totals[0], totals[1], totals[2]


def compressed_sizes(column: pa.Array, good: bytes, bad: bytes) -> np.ndarray:
    """Per text: bytes, plain, with the good and with the bad dictionary."""
    raw, off = text_buffers(column)
    view = memoryview(raw)
    compressors = _compressors(good, bad)
    return np.array([(off[i + 1] - off[i], *_sizes(view[off[i]:off[i + 1]], compressors)) for i in range(len(off) - 1)],
                    dtype=np.float64).reshape(-1, 4)


def features(sizes: np.ndarray) -> np.ndarray:
    """Intercept, normalised difference, log of the plain ratio, and their squares and product."""
    length, plain, good, bad = sizes.T
    some = length > 0
    d = np.where(some, (bad - good) / np.maximum(plain, 1), 0.0)
    # a frame has a fixed cost, so the ratio of short texts is taken after it
    r = np.where(some, np.log(np.maximum(plain - 9 * np.ceil(length / BLOCK), 1) / np.maximum(length, 1)), -0.6)
    return np.stack([np.ones_like(d), 10 * d, r, 30 * d * d, r * r, 10 * d * r], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton steps on the weighted, lightly penalised log loss."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples, their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b"\n"


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Dictionaries and calibration from the labelled rows given."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
    shares = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    prior = shares.get(1, 0) / total if (total := sum(shares.values())) else 0.5
    if len(shares) < 2:
        return Model(b"\n", b"\n", [], prior)
    # two samples of bounded size per class, by a hash of the id: a top-k that Spark keeps in a heap per task
    chosen = None
    per_class = SAMPLE_DOCS + CALIBRATION_DOCS
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    chosen = chosen.withColumn("dictionary", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(per_class)) < SAMPLE_DOCS)
    # the ids are at most 2 x per_class rows, so their broadcast is bounded
    rows = one_text(docs, chosen, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            for y, lo, hi in zip(batch.column("y"), off[:-1], off[1:]):
                for at in range(lo, hi, BLOCK * 1024):
                    pieces = [raw[a:min(a + BLOCK, hi)].tobytes() for a in range(at, min(at + BLOCK * 1024, hi), BLOCK)]
                    yield pa.RecordBatch.from_arrays([pa.array([y.as_py()] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())], ["y", "block"])

    # equal blocks meet by digest, and the sample is a top-k that Spark keeps in a heap per task
    cuts = (rows.where("dictionary").select("text", F.col("y").cast("int").alias("y")).mapInArrow(cut, "y int, block binary")
            .groupBy("y", F.sha2("block", 256).alias("digest")).agg(F.min("block").alias("block")))
    pooled = stored(cuts, "quality-blocks")
    blocks = {y: [bytes(r["block"]) for r in pooled.where(F.col("y") == y).orderBy("digest").limit(SAMPLE_BLOCKS).collect()] for y in (0, 1)}
    bad, good = _dictionary(blocks[0]), _dictionary(blocks[1])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = compressed_sizes(batch.column("text"), good, bad)
            yield pa.RecordBatch.from_arrays([batch.column("y"), *[pa.array(c) for c in sizes.T]], ["y", "n", "plain", "good", "bad"])

    held = rows.where(~F.col("dictionary")).select("text", F.col("y").cast("int").alias("y")).mapInArrow(measured, "y int, n double, plain double, good double, bad double").toPandas()
    if held.empty or held["y"].nunique() < 2:
        return Model(good, bad, [], prior)
    held = held.sort_values(list(held.columns))
    y = held["y"].to_numpy(float)
    # the classes are sampled apart, so each row weighs as its class does among all labels
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    return Model(good, bad, fit_logistic(features(held[["n", "plain", "good", "bad"]].to_numpy(float)), y, weight).tolist(), prior)


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    if not model.weights:
        return np.full(len(column), model.prior)
    return 1 / (1 + np.exp(-np.clip(features(compressed_sizes(column, model.good, model.bad)) @ np.array(model.weights), -30, 30)))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` without its text, plus ``out_col`` in [0, 1] (in place of a column of that name)."""
    rest = [f for f in docs.schema.fields if f.name not in (text_col, out_col)]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            keep = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(_scores(model, batch.column(at)))], [f.name for f in rest] + [out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return docs.mapInArrow(scored, f"{schema}{', ' if schema else ''}`{out_col}` double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns as they were."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            yield batch.filter(pa.array(_scores(model, batch.column(at)) >= least))

    return docs.mapInArrow(kept, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: fitted on labelled rows whose crc32 remainder by 4 is not 2, scored everywhere."""
    model = fit(docs, labels.where(id_remainder("doc_id", 4) != 2))
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return scored.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))
