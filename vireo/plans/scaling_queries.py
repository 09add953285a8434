"""Queries for scaling metrics over a run log built from events."""

from __future__ import annotations

from vireo.operators import scaling as sc
from vireo.plans.registry import query, table

RUNS_SQL = """(SELECT event_type AS job, CAST(1 << CAST(((user_id % 4) + 4) % 4 AS INTEGER) AS INTEGER) AS cores,
  count(*) AS "rows", avg(value) AS time FROM events GROUP BY 1, 2)"""


def _runs(spark, sf):
    return sc.run_log_from_events(table(spark, sf, "events"))


@query("strong_scaling", f"""
SELECT job, cores, time,
  round(arg_min(time, cores) OVER (PARTITION BY job) / time, 6) AS speedup,
  round(arg_min(time, cores) OVER (PARTITION BY job) / time / cores, 6) AS efficiency,
  round(CAST(cores AS DOUBLE) / min(cores) OVER (PARTITION BY job), 6) AS ideal
FROM {RUNS_SQL}""")
def q_strong_scaling(spark, sf):
    return sc.strong_scaling(_runs(spark, sf))


@query("weak_scaling", f"""
SELECT job, cores, time, round(time / arg_min(time, cores) OVER (PARTITION BY job), 6) AS relative_time,
  CAST(1.0 AS DOUBLE) AS ideal FROM {RUNS_SQL}""")
def q_weak_scaling(spark, sf):
    return sc.weak_scaling(_runs(spark, sf))


@query("size_impact", f"""
SELECT job, cores / 8.0 AS data_fraction, "rows", time FROM {RUNS_SQL} ORDER BY job, data_fraction""")
def q_size_impact(spark, sf):
    return sc.size_impact(_runs(spark, sf))
