"""Scan parallelism for CPU-heavy per-row work.

A Parquet file is read in parallel by row group.  Spark may cut a file into more
splits than it has row groups, and the splits without a row group's middle stay
empty; so a table stored as one large row group is one busy task, whatever the
number of partitions says.  ``spread`` therefore counts the scan's units, one for each
file and for each further ``ROW_GROUP_BYTES`` of it, and adds a repartition only
when they are fewer than a quarter of the session's cores.  Only plain scans
(with filters and projections) are judged: after an aggregate or a join the
partitions are the shuffle's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

MUCH_FEWER = 4
#: The usual size of a Parquet row group.
ROW_GROUP_BYTES = 128 << 20


def scan_units(df: DataFrame, enough: int) -> int | None:
    """About how many tasks of a plain file scan have rows (``enough`` or more: at least that many); None for other plans."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() in ("Project", "Filter"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    files = df.inputFiles()
    if len(files) >= enough or not files:
        return len(files) or None
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    units = 0
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        units += max(1, -(-path.getFileSystem(conf).getFileStatus(path).getLen() // ROW_GROUP_BYTES))
    return units


def spread(df: DataFrame, min_partitions: int | None = None, by: str | None = None) -> DataFrame:
    """``df`` dealt to ``min_partitions`` partitions (default: the cluster's default parallelism) if its
    scan has less than a quarter as many units.  With ``by`` the rows are hash-partitioned on that column
    (deterministic under task retries without a sort)."""
    if df.isStreaming:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    units = scan_units(df, -(-target // MUCH_FEWER))
    if units is None or units * MUCH_FEWER > target:
        return df
    return df.repartition(target, by) if by else df.repartition(target)
