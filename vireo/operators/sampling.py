"""Reproducible sampling and splitting by key hash.

A row's fate depends only on (seed, key), never on partitioning or task
retries, so samples are identical across cluster sizes, after executor loss,
and in the SQL twin.  Fractions are nested by construction: the 5 % sample
is inside the 10 % sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.functions.hashing import key_hash32, key_uniform, unit_from_hash
from vireo.functions.rows import rows_from
from vireo.operators.joins import materialize

U = "__u"
# Only the bucket of the 32-bit hash that holds a class's cut is ranked: with
# 2^16 buckets that is about one row in 65,536 of the class.
BUCKET_SHIFT = 16


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample -- keep rows with u(seed, key) < fraction."""
    return df.where(key_uniform(F.col(key), seed) < F.lit(float(fraction)))


def stratified_sample(df: DataFrame, label: str, fractions: dict, key: str, seed: int = 42) -> DataFrame:
    """per-class fraction; classes not in ``fractions`` are dropped."""
    frac = F.lit(0.0)
    for cls, f in fractions.items():
        frac = F.when(F.col(label) == F.lit(cls), F.lit(float(f))).otherwise(frac)
    return df.where(key_uniform(F.col(key), seed) < frac)


def split_column(key: str, weights: list[float], seed: int = 42):
    """Part index (0, 1, ...) by cumulative normalised weights."""
    total = float(sum(weights))
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        cuts.append(acc)
    u = key_uniform(F.col(key), seed)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(cuts))):
        part = F.when(u < F.lit(cuts[i]), F.lit(i)).otherwise(part)
    return part


def split(df: DataFrame, key: str, weights: list[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """disjoint, complete parts in proportion to ``weights``."""
    part = split_column(key, list(weights), seed)
    tagged = df.withColumn("__part", part)
    return [tagged.where(F.col("__part") == i).drop("__part") for i in range(len(weights))]


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """``df`` plus ``is_test``; the ceil(test_fraction * n_c) rows of each
    class c with the smallest (hash, key) are test.  A null label is a class of
    its own; rows that share a key stay together in one part.

    Rows are counted per (class, bucket of the hash's top bits).  Only the bucket
    that holds a class's cut is ranked, about n_c / 2^16 rows; it gives the
    (hash, key) of the last test row, and every row is compared with its
    class's cut.  The full rows are joined with one row per class and not
    shuffled unless there are very many classes.
    """
    h = key_hash32(F.col(key), seed)
    keys = df.select(F.col(label).alias("__c"), h.alias("__h"), F.col(key).alias("__k"))
    counts = materialize(keys.groupBy("__c", F.shiftright("__h", BUCKET_SHIFT).alias("__b")).agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy("__c").orderBy("__b")
    placed = counts.select("__c", "__b", "__n", (F.sum("__n").over(w) - F.col("__n")).alias("__before"),
                           F.sum("__n").over(Window.partitionBy("__c")).alias("__all"))
    tests = F.ceil(F.col("__all") * F.lit(float(test_fraction)))
    cut = placed.where((F.col("__before") < tests) & (tests <= F.col("__before") + F.col("__n"))).select(
        F.col("__c").alias("__cc"), F.col("__b").alias("__cb"), (tests - F.col("__before")).alias("__left"))
    inside = keys.join(cut, F.col("__c").eqNullSafe(F.col("__cc")) & (F.shiftright("__h", BUCKET_SHIFT) == F.col("__cb")))
    ranked = inside.withColumn("__rank", F.row_number().over(Window.partitionBy("__cc", "__cb").orderBy("__h", "__k")))
    last = materialize(ranked.where(F.col("__rank") == F.col("__left")).select("__cc", F.col("__h").alias("__ch"), F.col("__k").alias("__ck")))
    joined = df.withColumn("__h", h).join(last, F.col(label).eqNullSafe(F.col("__cc")), "left")
    is_test = (F.col("__h") < F.col("__ch")) | ((F.col("__h") == F.col("__ch")) & (F.col(key) <= F.col("__ck")))
    return joined.withColumn("is_test", F.coalesce(is_test, F.lit(False)).cast("int")).drop("__h", "__cc", "__ch", "__ck")


def head(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """first ``n`` rows by ``order_by`` (a distributed top-n)."""
    return df.orderBy(order_by).limit(n)


def capped_sample(df: DataFrame, key: str, max_rows: int, seed: int = 42) -> DataFrame:
    """fraction = min(max_rows / rows, 1), taken as a scalar subquery."""
    n = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    frac = F.least(F.lit(float(max_rows)) / n, F.lit(1.0))
    return df.where(key_uniform(F.col(key), seed) < frac)


def nested_fractions(df: DataFrame, key: str, fractions: list[float], seed: int = 42) -> DataFrame:
    """``(fraction, rows)`` for every fraction in one pass."""
    u = key_uniform(F.col(key), seed)
    row = df.agg(*[F.count_if(u < F.lit(float(f))).alias(f"f{i}") for i, f in enumerate(fractions)])
    return rows_from(row, [{"fraction": F.lit(float(f)), "rows": F.col(f"f{i}").cast("bigint")}
                           for i, f in enumerate(fractions)])


def fold_column(key: str, k: int, seed: int = 42):
    """Reproducible fold id in [0, k) for cross-validation (``foldCol``)."""
    return F.least(F.floor(unit_from_hash(key_hash32(F.col(key), seed)) * k), F.lit(k - 1)).cast("int")


def exact_sample(df: DataFrame, key: str, n: int, by: list[str] | None = None, seed: int = 42) -> DataFrame:
    """F2, F6 with exact sizes: the ``n`` rows (per ``by``) with the smallest (hash of key, key); all if fewer.

    A bottom-k sketch: every task keeps at most ``n`` rows a class before anything is shuffled, so a class with a
    third of all rows costs ``n`` rows a task, and the same rows come out under any partitioning.
    """
    order = [key_hash32(F.col(key), seed), F.col(key)]
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
