"""Derived scaling metrics over a run log.

A run log has one row per (job, cores[, data_fraction]) with a measured
``time``; any number of jobs.  The log is tiny, so the per-job baselines are
window aggregates over it rather than joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.functions.hashing import key_uniform
from vireo.operators.cumulative import below_sums

ROUND = 6


def strong_scaling(runs: DataFrame, job: str = "job", cores: str = "cores", time: str = "time") -> DataFrame:
    """speedup = t(fewest cores) / t, efficiency = speedup / cores,
    ideal = cores / fewest cores."""
    w = Window.partitionBy(job)
    base_t = F.min_by(F.col(time), F.col(cores)).over(w)
    base_c = F.min(F.col(cores)).over(w)
    speed = base_t / F.col(time)
    return runs.select(job, cores, time,
                       F.round(speed, ROUND).alias("speedup"),
                       F.round(speed / F.col(cores), ROUND).alias("efficiency"),
                       F.round(F.col(cores) / base_c, ROUND).alias("ideal"))


def weak_scaling(runs: DataFrame, job: str = "job", cores: str = "cores", time: str = "time") -> DataFrame:
    """Time relative to the fewest-cores run of the same job (ideal 1)."""
    base_t = F.min_by(F.col(time), F.col(cores)).over(Window.partitionBy(job))
    return runs.select(job, cores, time, F.round(F.col(time) / base_t, ROUND).alias("relative_time"),
                       F.lit(1.0).alias("ideal"))


def size_impact(runs: DataFrame, job: str = "job", fraction: str = "data_fraction",
                cols: tuple[str, ...] = ("rows", "time")) -> DataFrame:
    """Rows and time by data fraction, per job, in fraction order."""
    return runs.select(job, fraction, *cols).orderBy(job, fraction)


def size_scores(scored: DataFrame, key: str, fractions: list[float], label: str = "label", score: str = "score", seed: int = 42) -> DataFrame:
    """I3's ``auc``: (data_fraction, rows, auc) of a scored table on nested samples by key hash.

    Each row is read once and counted on every fraction that holds it; the cells of equal scores are
    pre-aggregated in the map tasks, and all fractions' curves are ranked together over range partitions.
    """
    at = F.explode(F.filter(F.array(*[F.lit(float(f)) for f in fractions]), lambda f: F.col("__u") < f))
    cells = scored.withColumn("__u", key_uniform(F.col(key), seed)).select(at.alias("data_fraction"), F.col(score).alias("s"), F.col(label).cast("long").alias("y"))
    cells = cells.groupBy("data_fraction", "s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ranked = below_sums(cells, "s", ["neg"], ["data_fraction"])
    wins = F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2.0))
    total = ranked.groupBy("data_fraction").agg((F.sum("pos") + F.sum("neg")).alias("rows"), (wins / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))
    return total.withColumn("auc", F.round("auc", ROUND))


def run_log_from_events(events: DataFrame) -> DataFrame:
    """A run log derived from an event table (for checks at any scale):
    job = event_type, cores = 2^(user_id mod 4), data share = cores / 8,
    rows = events, time = mean value."""
    cores = F.pow(F.lit(2.0), F.pmod(F.col("user_id"), F.lit(4))).cast("int")
    return (events.groupBy(F.col("event_type").alias("job"), cores.alias("cores"))
                  .agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("time"))
                  .withColumn("data_fraction", F.col("cores") / 8.0))
