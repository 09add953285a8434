"""Registry of named queries over the provided tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` and, when the
result is SQL-expressible, a DuckDB twin over the same parquet tables
(views ``documents``, ``labels``, ``events`` ...).  Column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.text import first_line

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The post view used throughout: documents with a summary (its first line).
POSTS_SQL = ("(SELECT doc_id, text, lang, source, n_chars, "
             "split_part(text, chr(10), 1) AS summary FROM documents)")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.withColumn("summary", first_line(F.col("text")))


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels ⋈ documents as an evaluation frame: label = quality,
    score = n_chars, prediction = score > 1000 (SURVEY §5.3)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (lab.join(doc, "doc_id")
               .select("doc_id", F.col("quality").cast("int").alias("label"),
                       F.col("n_chars").cast("double").alias("score"),
                       (F.col("n_chars") > 1000).cast("int").alias("prediction")))


SCORED_SQL = ("(SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label, CAST(d.n_chars AS DOUBLE) AS score, "
              "CAST(d.n_chars > 1000 AS INTEGER) AS prediction "
              "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)")
