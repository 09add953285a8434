"""Queries for reproducible sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from vireo.operators import sampling as smp
from vireo.plans.registry import query, table
from vireo.plans.sqlbits import u32, unit

U_DOC = unit(u32("doc_id"))
DOC_COLS = "doc_id, text, lang, source, n_chars"


@query("hash_sample", f"SELECT {DOC_COLS} FROM documents WHERE {U_DOC} < 0.1")
def q_hash_sample(spark, sf):
    return smp.hash_sample(table(spark, sf, "documents"), "doc_id", 0.1, seed=42)


@query("stratified_sample", f"""
SELECT doc_id, quality, toxic FROM labels
WHERE {U_DOC} < CASE WHEN quality = 1 THEN 0.1 WHEN quality = 0 THEN 0.5 ELSE 0.0 END""")
def q_stratified_sample(spark, sf):
    return smp.stratified_sample(table(spark, sf, "labels"), "quality", {0: 0.5, 1: 0.1}, "doc_id", 42)


@query("split", f"SELECT doc_id, CASE WHEN {U_DOC} < 0.8 THEN 0 ELSE 1 END AS part FROM documents")
def q_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    train, test = smp.split(d, "doc_id", [0.8, 0.2], 42)
    return train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))


@query("stratified_split", f"""
SELECT doc_id, quality, toxic,
  CAST(row_number() OVER (PARTITION BY quality ORDER BY {u32("doc_id")}, doc_id)
       <= ceil(count(*) OVER (PARTITION BY quality) * 0.2) AS INTEGER) AS is_test
FROM labels""")
def q_stratified_split(spark, sf):
    return smp.stratified_split(table(spark, sf, "labels"), "quality", "doc_id", 0.2, 42)


@query("head", f"SELECT {DOC_COLS} FROM documents ORDER BY doc_id LIMIT 200")
def q_head(spark, sf):
    return smp.head(table(spark, sf, "documents"), 200, "doc_id")


@query("capped_sample", f"""
SELECT {DOC_COLS} FROM documents
WHERE {U_DOC} < least(300.0 / (SELECT CAST(count(*) AS DOUBLE) FROM documents), 1.0)""")
def q_capped_sample(spark, sf):
    return smp.capped_sample(table(spark, sf, "documents"), "doc_id", 300, 42)


_FRACS = [0.05, 0.1, 0.25, 0.5, 0.75, 1.0]


@query("nested_fractions", "\nUNION ALL\n".join(
    f"SELECT CAST({f!r} AS DOUBLE) AS fraction, count_if({U_DOC} < {f!r})::BIGINT AS \"rows\" FROM documents" for f in _FRACS))
def q_nested_fractions(spark, sf):
    return smp.nested_fractions(table(spark, sf, "documents"), "doc_id", _FRACS, 42)
