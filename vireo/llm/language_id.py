"""Operator 11: language identification by nearest centroids.

A text is lower-cased, everything but letters and their marks becomes one space,
and its character n-grams of one to three are counted in ``SLOTS`` hashed slots.
Its vector is the root of the counts times the inverse document frequency,
normalised.  Each language has up to ``CENTROIDS`` centroids, found by
clustering vectors of its texts on the sphere, so a language's styles (prose,
lists, shouting) need not share one mean.  The nearest centroid by cosine names the language.

Rejection goes by distance: a text whose distance (one minus cosine) to its nearest
centroid is larger than nearly all training texts and pieces of the same length class
(powers of two of n-grams) have to their own language is marked as rejected.  The
score is the chance that the language is right, a logistic function of the
margin to the next language and of the length class.

What is fitted on a sample: centroids, distances and score, on about ``LEARN_TEXTS`` +
``CALIBRATION_TEXTS`` different texts of each language, chosen by a hash of the text.  The document
frequencies count all training texts, and every row's whole text is scored.
A model takes 64 KB for each centroid.

Defined cases: a null text or a text without a letter is ``und`` at score 0, not rejected, at distance 1; where
nothing is learned every text is; any non-null language value can be learned, if one of its texts has a letter; repeated rows are
one text in the sample and count as rows in the frequencies; equal cosines go to
the language that sorts first; columns named like a result are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import id_remainder, mix64, stored, worker_cache
from vireo.llm.zstd_quality import fit_logistic
from vireo.operators.joins import join_group_table

SLOTS, LONGEST = 1 << 14, 3
CENTROIDS, ROUNDS = 4, 12
LEARN_TEXTS, CALIBRATION_TEXTS = 500, 400
#: Share of a length class's training distances that lie below the limit, the room added to it, and least rows that set one.
REJECT_SHARE, REJECT_ROOM, REJECT_ROWS = 0.999, 0.05, 40
UNKNOWN = "und"
#: Characters that are counted at once.
SLICE = 1 << 20
RESULTS = "lang_pred string, score double, distance double, rejected boolean"


# ---------------------------------------------------------------- vectors of texts

def _classes() -> np.ndarray:
    """Per code point: 2 letter, 1 mark (stays inside words), 0 anything else."""
    cache = worker_cache()
    if "letters" not in cache:
        kinds = np.zeros(0x110000, dtype=np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                kinds[i] = 2
            elif i > 0x2FF and unicodedata.category(c)[0] == "M":
                kinds[i] = 1
        cache["letters"] = kinds
    return cache["letters"]


def letters(text: str) -> np.ndarray | None:
    """Lower-case code points with one space around and between words; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _classes()[points]
    if not (kind == 2).any():
        return None
    word = np.concatenate(([False], kind > 0, [False]))
    points = np.where(word, np.concatenate(([32], points, [32])), 32)
    return points[word | np.concatenate(([True], word[:-1]))].astype(np.uint64)


def counts(points: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """How often each slot's n-grams occur (single spaces are left out)."""
    out = np.zeros(slots, dtype=np.int64)
    shift = np.uint64(64 - slots.bit_length() + 1)
    for lo in range(0, len(points), SLICE):
        hi = min(lo + SLICE, len(points))
        with np.errstate(over="ignore"):
            part = points[lo:min(hi + LONGEST - 1, len(points))]
            gram = mix64(part)
            for n in range(1, LONGEST + 1):
                if n > 1:
                    gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix64(part[n - 1:])
                own = gram[:hi - lo]
                own = own[part[:len(own)] != 32] if n == 1 else own
                out += np.bincount(((own * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype(np.int64), minlength=slots)
    return out


def unit_vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of a text's normalised vector."""
    at = np.flatnonzero(count)
    weight = np.sqrt(count[at]) * idf[at]
    return at, weight / np.linalg.norm(weight)


def length_class(points: np.ndarray) -> int:
    return int(len(points)).bit_length()


# ---------------------------------------------------------------- the model

class Model:
    """Inverse document frequencies, the languages' centroids, distance limits and score weights."""

    def __init__(self, idf: np.ndarray, languages: list[str], owner: np.ndarray, centroids: np.ndarray):
        self.idf, self.languages, self.owner = idf, languages, owner
        self.by_slot = np.ascontiguousarray(centroids.T)  # slots x centroids
        self.limits: dict[tuple[int, int], float] = {}
        self.weights = np.zeros(3)

    def cosines(self, points: np.ndarray) -> np.ndarray:
        """The best cosine of every language."""
        at, weight = unit_vector(counts(points, len(self.idf)), self.idf)
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, weight @ self.by_slot[at])
        return best

    def measures(self, cosines: np.ndarray, points: np.ndarray) -> list[float]:
        second = np.partition(cosines, -2)[-2] if len(cosines) > 1 else 0.0
        return [1.0, 10 * (float(cosines.max()) - float(second)), length_class(points) / 10]

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        points = letters(text) if text and self.languages else None
        if points is None:
            return UNKNOWN, 0.0, 1.0, False
        cosines = self.cosines(points)
        best = int(np.argmax(cosines))
        distance = min(max(1.0 - float(cosines[best]), 0.0), 1.0)
        chance = 1 / (1 + np.exp(-np.clip(np.dot(self.measures(cosines, points), self.weights), -30, 30)))
        return self.languages[best], float(chance), distance, distance > self.limits.get((best, length_class(points)), 1.0)


def spherical_clusters(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit rows: farthest-first starts, then means by cosine; empty clusters go."""
    mean = x.mean(axis=0)
    chosen = [int(np.argmax(x @ mean))]
    near = x @ x[chosen[0]]
    while len(chosen) < k and near.min() < 1 - 1e-6:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centre = x[chosen]
    for _ in range(rounds):
        owner = np.argmax(x @ centre.T, axis=1)
        sums = np.stack([x[owner == c].sum(axis=0) for c in range(len(centre)) if (owner == c).any()])
        new = (sums / np.linalg.norm(sums, axis=1, keepdims=True)).astype(x.dtype)
        if new.shape == centre.shape and np.allclose(new, centre, atol=1e-6):
            break
        centre = new
    return centre


def document_frequencies(texts: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, int]:
    """(texts that have each slot, texts with a letter) over all rows of ``texts`` (column text).

    Every task sends one row a slot at most, and Spark sums them; the driver gets one row a slot.
    """
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, n = np.zeros(slots, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                points = letters(value.as_py() or "")
                if points is not None:
                    has += counts(points, slots) > 0
                    n += 1
        at = np.flatnonzero(has)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, slots).astype(np.int32)), pa.array(np.append(has[at], n))], ["slot", "n"])

    total = np.zeros(slots + 1, dtype=np.int64)
    for r in texts.select("text").mapInArrow(frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        total[r["slot"]] = r["n"]
    return total[:slots], int(total[slots])


def sample_texts(texts: DataFrame, per_language: int) -> DataFrame:
    """Stored (lang, text, learn): about ``per_language`` different texts of each language, all of a language with fewer.

    A text is taken by its hash against the language's number of different texts, so copies neither
    crowd others out nor reach the sample more than once.
    """
    key = F.xxhash64(F.lit(11), "text")
    sizes = stored(texts.groupBy("lang").agg(F.approx_count_distinct(key, 0.02).alias("different"), F.count("*").alias("rows")), "language-sizes")
    near = join_group_table(texts, sizes, ["lang"], "inner", size_col="rows")
    within = F.pmod(key, F.lit(1 << 30)) * F.col("different").cast("double") < F.lit(1.05 * per_language * (1 << 30))
    learn = F.pmod(F.xxhash64(F.lit(12), "text"), F.lit(per_language)) < F.lit(LEARN_TEXTS)
    return stored(near.where(within).select("lang", "text").distinct().withColumn("learn", learn), "language-sample")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS, centroids: int = CENTROIDS) -> Model:
    """A model of the rows given, whose language isn't null."""
    texts = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    has, n = document_frequencies(texts, slots)
    idf = (np.log((1 + n) / (1 + has)) + 1).astype(np.float32)
    sample = sample_texts(texts, LEARN_TEXTS + CALIBRATION_TEXTS)

    def clustered(group: pa.Table) -> pa.Table:
        rows = sorted((not learn, text) for learn, text in zip(group.column("learn").to_pylist(), group.column("text").to_pylist()))
        # a language with few texts learns from all of them
        rows = [t for held, t in rows if not held] if sum(not h for h, _ in rows) >= 20 else [t for _, t in rows]
        points = [p for p in map(letters, rows) if p is not None]
        x = np.zeros((len(points), slots), dtype=np.float32)
        for i, p in enumerate(points):
            at, weight = unit_vector(counts(p, slots), idf)
            x[i, at] = weight
        found = spherical_clusters(x, min(centroids, max(1, len(x) // 4))) if len(x) else x
        return pa.table([pa.array([group.column("lang")[0].as_py()] * len(found), pa.string()), pa.array([c.tobytes() for c in found], pa.binary())], ["lang", "centroid"])

    # a group holds the bounded sample of a language
    made = sample.groupBy("lang").applyInArrow(clustered, "lang string, centroid binary").collect()
    languages = sorted({r["lang"] for r in made})
    made = sorted((languages.index(r["lang"]), bytes(r["centroid"])) for r in made)
    table = np.array([np.frombuffer(c, np.float32) for _, c in made], dtype=np.float32).reshape(-1, slots)
    model = Model(idf, languages, np.array([i for i, _ in made], dtype=np.int64), table)
    return calibrated(model, sample) if languages else model


def calibrated(model: Model, sample: DataFrame) -> Model:
    """``model`` with distance limits and score weights from the texts that were held back and pieces of them."""
    number = {v: i for i, v in enumerate(model.languages)}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                points = letters(text)
                if points is None or lang not in number:
                    continue
                own, seed = number[lang], zlib.crc32(text.encode())
                # the whole text, and a piece of each smaller power of two of characters
                for size in [len(points), *[1 << e for e in range(4, 12) if 1 << e < len(points)]]:
                    at = seed % (len(points) - size + 1)
                    piece = points[at:at + size]
                    if (piece == 32).all():
                        continue
                    cosines = model.cosines(piece)
                    rows.append((own, length_class(piece), 1 - float(cosines[own]), int(np.argmax(cosines)) == own, *model.measures(cosines, piece)[1:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "size", "distance", "right", "margin", "length"])

    held = sample.where("NOT learn").repartition("lang", F.xxhash64("text")).mapInArrow(measured, "lang long, size long, distance double, right boolean, margin double, length double").toPandas()
    if held.empty:
        return model
    held = held.sort_values(list(held.columns))
    pooled = {size: g["distance"] for size, g in held.groupby("size")}
    own = {key: g["distance"] for key, g in held.groupby(["lang", "size"])}
    for size, everything in pooled.items():
        for lang in range(len(model.languages)):
            d = own.get((lang, size), everything[:0])
            d = d if len(d) >= REJECT_ROWS else everything
            if len(d) >= REJECT_ROWS:
                model.limits[lang, int(size)] = float(d.quantile(REJECT_SHARE)) + REJECT_ROOM
    x = np.column_stack([np.ones(len(held)), held["margin"], held["length"]])
    model.weights = fit_logistic(x, held["right"].to_numpy(float), np.ones(len(held)), ridge=0.1)
    return model


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus lang_pred, score, distance and rejected."""
    names = [c.split()[0] for c in RESULTS.split(", ")]
    rest = [f for f in docs.schema.fields if f.name not in (text_col, *names)]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(v.as_py()) for v in batch.column("text")]
            columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(rest))], *columns], [f.name for f in rest] + names)

    source = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return source.mapInArrow(predicted, f"{schema}{', ' if schema else ''}{RESULTS}")


def languages(docs: DataFrame) -> DataFrame:
    """The contract's columns: learned from rows whose crc32 remainder by 4 is not 2, predicted everywhere."""
    model = fit(docs.where(id_remainder("doc_id", 4) != 2))
    return classify(docs.select("doc_id", "text"), model).select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "distance", "rejected")
