"""Source/sink queries: each writes a derived copy of a given
table into a fresh folder under the shared checkpoint root, reads it back
through the operator under test, and returns what it read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators import profile
from vireo.plans import marts
from vireo.plans.registry import ORACLE, query, table
from vireo.plans.sqlbits import features_sql, u32, unit
from vireo.session import scratch_dir
from vireo.sources import files
from vireo.streaming.features_stream import run_feature_stream

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])


def _fresh(spark, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_roundtrip(spark, sf):
    path = _fresh(spark, "documents-csv")
    files.write_csv(table(spark, sf, "documents"), path)
    return files.read_posts_csv(spark, path, DOC_SCHEMA)


@query("csv_lines")
def q_csv_lines(spark, sf):
    """Single-line reading of a file with embedded newlines: records split at
    every newline; malformed pieces are dropped (rows-only)."""
    path = _fresh(spark, "documents-csv-lines")
    files.write_csv(table(spark, sf, "documents"), path)
    return files.read_csv_lines(spark, path, DOC_SCHEMA, bad="drop")


@query("csv_lines_flat", r"SELECT doc_id, regexp_replace(text, '[\n\r]', ' ', 'g') AS text, lang, source, n_chars FROM documents")
def q_csv_lines_flat(spark, sf):
    """Single-line reading of texts without line ends: every record comes back whole."""
    path = _fresh(spark, "documents-csv-flat")
    files.write_csv(table(spark, sf, "documents").withColumn("text", F.regexp_replace("text", r"[\n\r]", " ")), path)
    return files.read_csv_lines(spark, path, DOC_SCHEMA, bad="drop")


@query("csv_inferred", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_inferred(spark, sf):
    path = _fresh(spark, "documents-csv-infer")
    files.write_csv(table(spark, sf, "documents"), path)
    return files.read_csv_inferred(spark, path).select(
        F.col("doc_id").cast("bigint"), "text", "lang", "source", F.col("n_chars").cast("bigint"))


@query("parquet_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_parquet_roundtrip(spark, sf):
    path = _fresh(spark, "documents-parquet")
    files.write_parquet(table(spark, sf, "documents"), path)
    return files.read_parquet(spark, path)


@query("partition_pruned_read", "SELECT doc_id, text, source, n_chars, lang FROM documents WHERE lang = 'en'")
def q_partition_pruned_read(spark, sf):
    path = _fresh(spark, "documents-by-lang")
    files.write_partitioned(table(spark, sf, "documents"), path, "lang")
    return files.read_partition(spark, path, F.col("lang") == "en")


@query("storage_report", """
SELECT lang, count(*) AS "rows", CAST(sum(strlen(coalesce(text, '')) + strlen(coalesce(source, ''))) AS BIGINT) AS text_bytes
FROM documents GROUP BY lang""")
def q_storage_report(spark, sf):
    """Rows and text bytes per partition value; files and stored bytes depend on the writer and are checked for presence."""
    path = _fresh(spark, "documents-by-lang-report")
    files.write_partitioned(table(spark, sf, "documents"), path, "lang")
    report = files.storage_report(spark.read.parquet(path), ["lang"])
    return report.where("files > 0 AND bytes > 0").select("lang", "rows", F.col("text_bytes").cast("bigint").alias("text_bytes"))


@query("mart_roundtrip", """
WITH g AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) AS INTEGER) AS rank,
       (SELECT count(*) FROM g) AS total_groups
FROM g ORDER BY n DESC, user_id LIMIT 30""")
def q_mart_roundtrip(spark, sf):
    path = _fresh(spark, "mart-group-distribution")
    files.write_mart(profile.group_distribution(table(spark, sf, "events"), "user_id", k=30), path)
    return files.read_mart(spark, path, "user_id bigint, n bigint, rank int, total_groups bigint")


_FEATS = ",\n       ".join(features_sql("text", "NULL", "ref"))


@query("stream_text_features", f"SELECT doc_id,\n       {_FEATS}\nFROM documents")
def q_stream_text_features(spark, sf):
    """The ref features computed by a Structured Streaming query (available-now
    trigger, Parquet sink, checkpointed) must equal the batch result."""
    src = _fresh(spark, "stream-src")
    docs = table(spark, sf, "documents")
    files.write_parquet(docs.repartition(files.file_count(docs, least=4)), src)
    sink, ckpt = _fresh(spark, "stream-sink"), _fresh(spark, "stream-ckpt")
    run_feature_stream(spark, src, sink, ckpt, "text", None, mode="ref")
    return spark.read.parquet(sink).select("doc_id", *NUMERIC_FEATURES)


# ------------------------------------------------ marts, written and read back

def _mart(name: str, twin: str, build, schema: str):
    """``twin`` is a registered query's name or SQL of its own."""
    def run(spark, sf):
        path = _fresh(spark, name)
        files.write_mart(build(spark, sf), path)
        return files.read_mart(spark, path, schema)
    query(name, ORACLE.get(twin, twin))(run)


_mart("mart_data_quality", "missing_profile", lambda s, sf: marts.data_quality_mart(s, sf)["missing"], "`column` string, missing bigint, pct double")
_mart("mart_insights", "class_profile", lambda s, sf: marts.insight_mart(s, sf)["class_profile"], "feature string, mean_0 double, mean_1 double, diff double")
_mart("mart_scaling", "strong_scaling", lambda s, sf: marts.scaling_mart(s, sf)["strong"], "job string, cores int, time double, speedup double, efficiency double, ideal double")

_LABELLED = "FROM documents JOIN labels USING (doc_id)"
_mart("mart_overview", "dataset_overview", lambda s, sf: marts.data_quality_mart(s, sf)["overview"], "metric string, value double")
_mart("mart_classes", "class_distribution", lambda s, sf: marts.data_quality_mart(s, sf)["classes"], "quality int, n bigint, share double")
_mart("mart_groups", """
SELECT lang, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) AS INTEGER) AS rank, count(*) OVER () AS total_groups
FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 30""",
      lambda s, sf: marts.insight_mart(s, sf)["groups"], "lang string, n bigint, rank int, total_groups bigint")
_mart("mart_catalog", ORACLE["catalog"].replace("FROM documents)", f"{_LABELLED})"), lambda s, sf: marts.insight_mart(s, sf)["catalog"],
      "`index` int, name string, category string, description string, mean double, stddev double")
_mart("mart_feature_sample", f"{ORACLE['eda_features']}\nWHERE {unit(u32('d.doc_id'))} < 0.05", lambda s, sf: marts.insight_mart(s, sf)["feature_sample"],
      "body_length bigint, summary_length bigint, word_count bigint, has_url int, question_marks int, exclamation_marks int, quality int")
_mart("mart_weak_scaling", "weak_scaling", lambda s, sf: marts.scaling_mart(s, sf)["weak"], "job string, cores int, time double, relative_time double, ideal double")
_mart("mart_size_impact", "size_impact", lambda s, sf: marts.scaling_mart(s, sf)["size"], "job string, data_fraction double, `rows` bigint, time double")
