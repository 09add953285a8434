"""Text features over a stream of new files.

The feature operator is a pure projection, so it runs unchanged under
Structured Streaming: each micro-batch of new Parquet files is projected and
appended to a Parquet sink.  The checkpoint (offsets + commit log) lives in
the shared checkpoint folder, so a restarted or re-scheduled query resumes
exactly where it stopped and never writes a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vireo.operators.features import text_features


def feature_stream(spark: SparkSession, source_dir: str, text_col: str, summary_col: str | None = None,
                   mode: str = "ref", max_files_per_trigger: int = 64) -> DataFrame:
    """A streaming frame: new Parquet files under ``source_dir`` with the
    13 features appended.  The schema is taken from the files present."""
    schema = spark.read.parquet(source_dir).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    return text_features(stream, text_col, summary_col, mode=mode)


def run_feature_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                       text_col: str, summary_col: str | None = None, mode: str = "ref",
                       available_now: bool = True):
    """Start (and with ``available_now`` drain) the feature stream into a
    Parquet sink; returns the ``StreamingQuery``."""
    q = (feature_stream(spark, source_dir, text_col, summary_col, mode)
         .writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    started = q.start()
    if available_now:
        started.awaitTermination()
    return started
