"""The opN_<name> queries: each operator applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import ann_blocks, collision, hard_negatives, hmm, language_id, mixing, near_dup, ordinal, packing, prefix_trie, secrets, url_lists, zstd_quality
from vireo.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_blocks.nearest(table(spark, sf_dir, "embeddings"))


@query
def op2_bagminhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_classes(table(spark, sf_dir, "documents"))


#: Captures and list entries for ``pages``, which has neither: times and dated changes follow from ids and hosts.
YEAR_START, YEAR_SECONDS, DAY = 1_704_067_200, 31_622_400, 86_400


def page_captures(pages: DataFrame) -> DataFrame:
    fetched = F.timestamp_seconds(F.lit(YEAR_START) + F.pmod(F.col("page_id") * 7919, F.lit(YEAR_SECONDS)))
    return pages.select("page_id", "url", fetched.alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Changes for every host, its registered domain and its ``/en/`` paths, dated by digests of their names."""
    digest = lambda c: F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
    hosts = pages.select(url_lists.url_host(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("k", digest(F.col("host")))
    domains = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("host")).where("host <> ''").distinct().withColumn("k", digest(F.col("host")))
    changes = [
        (hosts, "k % 3 <> 0", "abuse", "host", "host", "block", "k % 200"),
        (hosts, "k % 3 <> 0", "abuse", "host", "host", "remove", "k % 200 + 20 + k % 50"),
        (hosts, "k % 3 = 1", "abuse", "host", "host", "block", "k % 200 + 90 + k % 60"),
        (domains, "k % 2 = 0", "parked", "domain", "host", "block", "150 + k % 30"),
        (domains, "k % 2 = 0", "parked", "domain", "host", "remove", "260 + k % 40"),
        (hosts, "k % 5 < 3", "vetted", "prefix", "host || '/en/'", "allow", "k % 100"),
        (hosts, "k % 5 = 0", "vetted", "prefix", "host || '/en/'", "remove", "k % 100 + 120"),
    ]
    out = None
    for rows, where, name, scope, pattern, action, day in changes:
        part = rows.where(where).select(F.lit(name).alias("list_name"), F.lit(scope).alias("scope"), F.expr(pattern).alias("pattern"), F.lit(action).alias("action"),
                                        F.timestamp_seconds(F.expr(f"{YEAR_START} + ({day}) * {DAY}")).alias("changed_at"))
        out = part if out is None else out.union(part)
    return out


@query
def op3_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_lists.filtered(page_captures(pages), dated_entries(pages))
    seconds = [F.unix_seconds(a).alias(b) for a, b in (("fetched_at", "fetched_s"), ("valid_from", "valid_from_s"), ("valid_to", "valid_to_s"))]
    return judged.select("page_id", "url", "verdict", "list_name", "scope", "pattern", *seconds)


ORACLE["op3_temporal_url_lists"] = f"""
WITH captures AS (
  SELECT page_id, url, {YEAR_START} + ((page_id * 7919) % {YEAR_SECONDS} + {YEAR_SECONDS}) % {YEAR_SECONDS} AS fetched_s,
         lower(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\\.$', '')) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hosts AS (SELECT host, CAST('0x' || substr(md5(host), 1, 8) AS BIGINT) AS k FROM (SELECT DISTINCT host FROM captures WHERE host <> '')),
domains AS (SELECT host, CAST('0x' || substr(md5(host), 1, 8) AS BIGINT) AS k
            FROM (SELECT DISTINCT regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS host FROM hosts) WHERE host <> ''),
changes AS (
  SELECT 'abuse' AS list_name, 'host' AS scope, host AS pattern, 'block' AS action, k % 200 AS day FROM hosts WHERE k % 3 <> 0
  UNION ALL SELECT 'abuse', 'host', host, 'remove', k % 200 + 20 + k % 50 FROM hosts WHERE k % 3 <> 0
  UNION ALL SELECT 'abuse', 'host', host, 'block', k % 200 + 90 + k % 60 FROM hosts WHERE k % 3 = 1
  UNION ALL SELECT 'parked', 'domain', host, 'block', 150 + k % 30 FROM domains WHERE k % 2 = 0
  UNION ALL SELECT 'parked', 'domain', host, 'remove', 260 + k % 40 FROM domains WHERE k % 2 = 0
  UNION ALL SELECT 'vetted', 'prefix', host || '/en/', 'allow', k % 100 FROM hosts WHERE k % 5 < 3
  UNION ALL SELECT 'vetted', 'prefix', host || '/en/', 'remove', k % 100 + 120 FROM hosts WHERE k % 5 = 0),
dated AS (
  SELECT list_name, scope, pattern, {YEAR_START} + day * {DAY} AS since, max(CASE action WHEN 'remove' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS act
  FROM changes GROUP BY ALL),
ranged AS (
  SELECT *, lead(since) OVER (PARTITION BY list_name, scope, pattern ORDER BY since) AS until FROM dated),
hits AS (
  SELECT c.page_id, c.url, c.fetched_s, r.*, row_number() OVER (PARTITION BY c.page_id, c.url, c.fetched_s ORDER BY
         CASE r.scope WHEN 'prefix' THEN 1 WHEN 'host' THEN 2 ELSE 3 END, length(r.pattern) DESC, r.act DESC, r.list_name) AS nth
  FROM captures c JOIN ranged r ON r.act > 1 AND c.host <> '' AND c.fetched_s >= r.since AND (r.until IS NULL OR c.fetched_s < r.until)
   AND CASE r.scope WHEN 'host' THEN c.host = r.pattern
                    WHEN 'domain' THEN c.host = r.pattern OR ends_with(c.host, '.' || r.pattern)
                    ELSE starts_with(c.host || CASE WHEN c.path = '' THEN '/' ELSE c.path END, r.pattern) END)
SELECT c.page_id, c.url, CASE h.act WHEN 3 THEN 'block' WHEN 2 THEN 'allow' ELSE 'none' END AS verdict, h.list_name, h.scope, h.pattern,
       c.fetched_s, h.since AS valid_from_s, h.until AS valid_to_s
FROM captures c LEFT JOIN hits h ON h.nth = 1 AND h.page_id = c.page_id AND h.url = c.url AND h.fetched_s = c.fetched_s
"""


@query
def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_collision_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision.vector_classes(table(spark, sf_dir, "embeddings"))


@query
def op10_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query
def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.toxicity_severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.language_model_scores(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


@query
def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


@query
def op12_segment_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.shifted_labels(table(spark, sf_dir, "embeddings")))


@query
def op13_z_fast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_conversation_trie(table(spark, sf_dir, "conversations"))
