"""Queries over bucketed tables: each lays given tables out by key, then works on the stored layout."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vireo.operators import clean
from vireo.plans.registry import ORACLE, query, table
from vireo.session import scratch_dir
from vireo.sources import bucketed


def _fresh(spark, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("bucketed_dedup", ORACLE["dedup_text"])
def q_bucketed_dedup(spark, sf):
    """C2 on documents bucketed by text digest: the texts move once, when the table is written."""
    docs = table(spark, sf, "documents").withColumn("digest", clean.key_digest(["text"]))
    laid = bucketed.write_bucketed({"documents": docs}, _fresh(spark, "documents-by-digest"), ["digest"])["documents"]
    return bucketed.first_rows(laid, "doc_id").drop("digest")


@query("bucketed_join", "SELECT doc_id, l.quality, d.lang, strlen(d.text) AS text_bytes FROM documents d JOIN labels l USING (doc_id)")
def q_bucketed_join(spark, sf):
    """Documents ⋈ labels, both bucketed by id: no shuffle of texts."""
    sides = {"labels": table(spark, sf, "labels"), "documents": table(spark, sf, "documents")}
    laid = bucketed.write_bucketed(sides, _fresh(spark, "documents-labels"), ["doc_id"])
    both = bucketed.join_bucketed(laid["documents"], laid["labels"])
    return both.select("doc_id", "quality", "lang", F.octet_length("text").cast("bigint").alias("text_bytes"))


@query("bucketed_orders", """
SELECT o_orderkey, o_custkey, count(l_orderkey) AS lines, sum(CAST(round(l_quantity) AS BIGINT)) AS quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey""")
def q_bucketed_orders(spark, sf):
    """Orders with their lines' sums: join and aggregation by the same key, in several buckets."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("quantity"))
    sides = {"orders": table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "lines": lines}
    laid = bucketed.write_bucketed(sides, _fresh(spark, "orders-lines"), ["o_orderkey"], rows_per_bucket=100_000)
    sums = [F.count("line").alias("lines"), F.sum(F.round("quantity").cast("bigint")).alias("quantity")]
    both = bucketed.join_bucketed(laid["orders"], bucketed.Bucketed(*[p.withColumn("line", F.lit(1)) for p in (laid["lines"].cold, laid["lines"].hot)], laid["lines"].keys, laid["lines"].buckets), "left")
    return both.groupBy("o_orderkey", "o_custkey").agg(*sums)


@query("bucketed_groups", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def q_bucketed_groups(spark, sf):
    """C7's group sizes on events bucketed by user."""
    events = table(spark, sf, "events")
    laid = bucketed.write_bucketed({"events": events}, _fresh(spark, "events-by-user"), ["user_id"], rows_per_bucket=50_000)["events"]
    return bucketed.group_sizes(laid)
