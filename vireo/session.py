"""Session helpers: a local session for tests/bench, and the shared
checkpoint folder that cuts lineage on a cluster."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vireo") -> SparkSession:
    """A non-interactive local session: UI off, AQE on, UTC, ANSI default."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Unset, a ``local`` master (tests, a laptop) gets a fresh
    scratch folder that goes when the process ends; a cluster gets an error, as no local folder is shared there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vireo-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (the data is on shared storage, not in executor
    memory), unlike ``localCheckpoint`` which this library never uses.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "vireo-tables", name)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables this library wrote under the checkpoint root, once no frame reads them any more.

    Checkpoints themselves are Spark's: ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes them
    as their frames are released.
    """
    root = ensure_checkpoint_dir(spark)
    for name in ("vireo-tables", "vireo-llm"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
