"""The feature stream resumes from its checkpoint: a restarted query picks up
only files that arrived since, and never writes a row twice."""

import os
import tempfile

from conftest import SF_SMALL
from vireo.operators.sampling import split
from vireo.streaming.features_stream import run_feature_stream


def test_stream_resumes_from_checkpoint(spark):
    root = tempfile.mkdtemp(prefix="vireo-stream-")
    src, sink, ckpt = (os.path.join(root, d) for d in ("src", "sink", "ckpt"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first, second = split(docs, "doc_id", [0.5, 0.5])  # two arrival batches, together all rows
    first.write.mode("append").parquet(src)
    run_feature_stream(spark, src, sink, ckpt, "text")
    assert spark.read.parquet(sink).count() == first.count()
    second.write.mode("append").parquet(src)            # new files arrive
    run_feature_stream(spark, src, sink, ckpt, "text")  # a restarted query
    out = spark.read.parquet(sink)
    assert out.count() == docs.count()
    assert out.select("doc_id").distinct().count() == docs.count()
