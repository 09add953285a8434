"""Buckets, files and streams sized by bytes as well as by rows."""

import glob
import tempfile
import uuid

import pytest

from vireo.plans import load_all
from vireo.plans.registry import QUERIES
from vireo.session import scratch_dir
from vireo.sources import bucketed, files
from conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def wide(spark):
    """120 rows of 1,000 bytes, a third of them of one key, with line ends in the text."""
    return spark.createDataFrame([(0 if i % 3 == 0 else i, i, "de" if i % 4 else None, f"{i}\n" + "x" * 1000) for i in range(120)], "k long, v long, lang string, t string")


def test_buckets_by_bytes(spark, wide):
    names = spark.createDataFrame([(i, f"n{i}") for i in range(120)], "k long, name string")
    path = scratch_dir(spark, f"bucketed-{uuid.uuid4().hex}")
    laid = bucketed.write_bucketed({"wide": wide, "names": names}, path, ["k"], bytes_per_bucket=10_000)
    assert laid["wide"].buckets == laid["names"].buckets >= 12
    assert [r["k"] for r in laid["wide"].hot.select("k").distinct().collect()] == [0]  # 40 rows, 40,000 bytes
    assert rows(laid["wide"].rows()) == rows(wide)
    assert rows(bucketed.join_bucketed(laid["wide"], laid["names"])) == rows(wide.join(names, ["k"]))


def test_partition_files_by_bytes(spark, wide):
    path = scratch_dir(spark, f"parts-{uuid.uuid4().hex}")
    files.write_partitioned(wide, path, "lang", bytes_per_file=10_000)
    assert len(glob.glob(f"{path.removeprefix('file:')}/lang=de/*.parquet")) >= 5
    assert rows(spark.read.parquet(path).select(wide.columns)) == rows(wide)


def test_csv_files_by_bytes(spark, wide):
    path = tempfile.mkdtemp(prefix="vireo-csv-") + "/t"
    files.write_csv(wide.coalesce(1), path, bytes_per_file=10_000)
    assert len(glob.glob(f"{path}/*.csv")) >= 10
    assert rows(files.read_posts_csv(spark, path, wide.schema)) == rows(wide)
    files.write_csv(wide.limit(0), path)
    assert files.read_posts_csv(spark, path, wide.schema).count() == 0


def test_stream_source_by_bytes(spark, wide, monkeypatch):
    assert files.file_count(wide, 4) == 4 and files.file_count(wide, 4, 10_000) >= 12 and files.file_count(wide.limit(0)) == 1
    load_all()
    count, seen = files.file_count, []
    monkeypatch.setattr(files, "file_count", lambda df, least=1: seen.append(count(df, least, 10_000)) or seen[-1])
    out = QUERIES["stream_text_features"](spark, SF_SMALL)
    assert seen[0] > 4 and out.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
