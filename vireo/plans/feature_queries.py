"""Queries for text features and vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators import vectors as vec
from vireo.operators.models import fit_pipeline
from vireo.operators.features import eda_features, summary_features, text_features, unique_word_ratio_stage
from vireo.plans.registry import posts, query, table
from vireo.plans.sqlbits import features_sql, rnd

_SUMMARY = "split_part(text, chr(10), 1)"


def _features_query(mode: str):
    feats = ",\n       ".join(features_sql("text", _SUMMARY, mode))

    def run(spark, sf):
        d = posts(spark, sf)
        return text_features(d, "text", "summary", mode=mode).select("doc_id", *NUMERIC_FEATURES)
    return f"SELECT doc_id,\n       {feats}\nFROM documents", run


for _mode in ("ref", "script", "words", "notebook"):
    _sql, _fn = _features_query(_mode)
    query(f"text_features_{_mode}", _sql)(_fn)


@query("summary_features", f"""
SELECT doc_id, CAST(length(coalesce({_SUMMARY}, '')) AS DOUBLE) AS summary_length,
       CAST(len(string_split_regex(coalesce({_SUMMARY}, ''), '\\s+')) AS DOUBLE) AS summary_word_count,
       CASE WHEN length(text) > 0 THEN length(coalesce({_SUMMARY}, '')) / length(text) ELSE 0.0 END AS content_density
FROM documents""")
def q_summary_features(spark, sf):
    d = posts(spark, sf).withColumn("char_count", F.length("text"))
    return summary_features(d, "summary").select("doc_id", "summary_length", "summary_word_count", "content_density")


@query("unique_word_ratio", """
SELECT doc_id, CASE WHEN len(string_split_regex(text, '\\s+')) > 0
  THEN len(list_distinct(string_split(text, ' '))) / len(string_split_regex(text, '\\s+')) ELSE 0.0 END
  AS unique_word_ratio
FROM documents""")
def q_unique_word_ratio(spark, sf):
    d = table(spark, sf, "documents").withColumn("word_count", F.size(F.split("text", r"\s+")).cast("double"))
    return unique_word_ratio_stage("text").transform(d).select("doc_id", "unique_word_ratio")


@query("eda_features", """
SELECT length(d.text) AS body_length, length(split_part(d.text, chr(10), 1)) AS summary_length,
       len(string_split_regex(d.text, '\\s+')) AS word_count,
       CASE WHEN regexp_matches(d.text, 'https?://') THEN 1 ELSE 0 END AS has_url,
       CAST(length(d.text) - length(replace(d.text, '?', '')) AS INTEGER) AS question_marks,
       CAST(length(d.text) - length(replace(d.text, '!', '')) AS INTEGER) AS exclamation_marks,
       l.quality AS quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_eda_features(spark, sf):
    j = posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    out = eda_features(j, "text", "summary", "quality")
    return out.select(F.col("body_length").cast("bigint").alias("body_length"),
                      F.col("summary_length").cast("bigint").alias("summary_length"),
                      F.col("word_count").cast("bigint").alias("word_count"),
                      "has_url", "question_marks", "exclamation_marks", "quality")


@query("has_url", """
SELECT page_id, CAST(CASE WHEN regexp_matches(coalesce(html, ''), 'https?://\\S+') THEN 1.0 ELSE 0.0 END AS DOUBLE) AS has_url
FROM pages""")
def q_has_url(spark, sf):
    p = table(spark, sf, "pages")
    return text_features(p, "html", None, mode="ref", features=["has_url"]).select("page_id", "has_url")


_SW = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in vec.stop_words()) + "]"


@query("tokens", """
SELECT doc_id, token, count(*) AS n
FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\x{0B}\\f\\r]')) AS token FROM documents)
WHERE token <> '' GROUP BY doc_id, token""")
def q_tokens(spark, sf):
    t = vec.tokenize(table(spark, sf, "documents"), "text", "words")
    return (t.select("doc_id", F.explode("words").alias("token")).where(F.col("token") != "")
             .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))


@query("stopwords_removed", f"""
SELECT doc_id, token, count(*) AS n
FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\x{{0B}}\\f\\r]')) AS token FROM documents)
WHERE token <> '' AND NOT list_contains({_SW}, token) GROUP BY doc_id, token""")
def q_stopwords_removed(spark, sf):
    t = vec.remove_stopwords(vec.tokenize(table(spark, sf, "documents"), "text", "words"))
    return (t.select("doc_id", F.explode("filtered_words").alias("token")).where(F.col("token") != "")
             .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))


@query("term_stats", f"""
WITH tok AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\x{{0B}}\\f\\r]')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term <> '' AND NOT list_contains({_SW}, term)
       GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents)
SELECT doc_id, tf.term, tf, df, {rnd("ln((n + 1.0) / (df + 1.0))")} AS idf,
       {rnd("tf * ln((n + 1.0) / (df + 1.0))")} AS tfidf
FROM tf JOIN dfs ON tf.term = dfs.term, n""")
def q_term_stats(spark, sf):
    t = vec.term_stats(table(spark, sf, "documents"), "doc_id", "text", min_doc_freq=0)
    return t.select("doc_id", "term", "tf", "df", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


@query("vocab_tfidf", f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{vec.WORD_TOKEN}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term <> '' AND NOT list_contains({_SW}, term)
       GROUP BY doc_id, term),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
pt AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
vocab AS (SELECT term, ln((n + 1.0) / (df + 1.0)) + 1.0 AS idf FROM pt, n
          WHERE df >= 5 AND df <= n * 0.8 ORDER BY cf DESC, term LIMIT 2000),
raw AS (SELECT doc_id, tf.term, tf * idf AS w FROM tf JOIN vocab ON tf.term = vocab.term)
SELECT doc_id, term, {rnd("w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))")} AS tfidf FROM raw""")
def q_vocab_tfidf(spark, sf):
    t = vec.vocab_tfidf(table(spark, sf, "documents"), "doc_id", "text", max_features=2000, min_df=5, max_df=0.8)
    return t.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query("group_index", """
WITH s AS (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) - 1 AS DOUBLE) AS "index"
FROM s WHERE user_id IS NOT NULL
UNION ALL
SELECT user_id, n, CAST((SELECT count(*) FROM s WHERE user_id IS NOT NULL) AS DOUBLE) FROM s WHERE user_id IS NULL""")
def q_group_index(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"))
    return vec.group_index_table(e, "user_id")


_SCALE_COLS = ["char_count", "word_count", "sentence_count", "question_count", "has_url", "paragraph_count"]


def _scaled_sql() -> str:
    feats = [f for f in features_sql("text", _SUMMARY, "ref") if f.rsplit(" AS ", 1)[1] in _SCALE_COLS]
    sds = ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in _SCALE_COLS)
    outs = ", ".join(rnd(f"CASE WHEN sd_{c} > 0 THEN {c} / sd_{c} ELSE 0.0 END") + f" AS {c}" for c in _SCALE_COLS)
    return f"WITH f AS (SELECT doc_id, {', '.join(feats)} FROM documents), s AS (SELECT {sds} FROM f)\n" \
           f"SELECT doc_id, {outs} FROM f, s"


@query("scaled_numeric", _scaled_sql())
def q_scaled_numeric(spark, sf):
    f = text_features(posts(spark, sf), "text", "summary", mode="ref", features=_SCALE_COLS)
    s = vec.scale_columns(f, _SCALE_COLS, keep=["doc_id"])
    return s.select("doc_id", *[F.round(c, 6).alias(c) for c in _SCALE_COLS])


# ------------------------------------------------ vector outputs (rows-only)

def _tokens_frame(spark, sf):
    return vec.remove_stopwords(vec.tokenize(table(spark, sf, "documents"), "text", "words"))


# Java's String.split drops trailing empty pieces; whitespace-only text gives none
_JTOK = ("CASE WHEN rtrim(lower(text), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' "
         "AND text <> '' THEN [] ELSE string_split_regex(rtrim(lower(text), chr(32) || chr(9) || chr(10) || "
         "chr(11) || chr(12) || chr(13)), '[ \\t\\n\\x{0B}\\f\\r]') END")


@query("hashing_tf", f"""
SELECT doc_id, CAST(len(list_filter({_JTOK}, lambda t: NOT list_contains({_SW}, t))) AS DOUBLE) AS n_terms,
       CAST(len(list_filter({_JTOK}, lambda t: NOT list_contains({_SW}, t))) AS INTEGER) AS n_tokens
FROM documents""")
def q_hashing_tf(spark, sf):
    tf = vec.hashing_tf(_tokens_frame(spark, sf), num_features=5000)
    return tf.select("doc_id", F.aggregate(vector_to_array("raw_tf"), F.lit(0.0), lambda a, x: a + x)
                     .alias("n_terms"), F.size("filtered_words").alias("n_tokens"))


@query("idf", f"""
SELECT doc_id, CAST(len(list_filter({_JTOK}, lambda t: NOT list_contains({_SW}, t))) AS DOUBLE) AS n_terms, true AS consistent
FROM documents""")
def q_idf(spark, sf):
    """E4 by value: in every document every slot's weight is its term count x the idf of the slot's document
    frequency, counted here apart from the model (a row per slot, so at most 5000)."""
    tf = vec.hashing_tf(_tokens_frame(spark, sf), num_features=5000)
    both = vec.fit_idf(tf, min_doc_freq=5).transform(tf).select("doc_id", F.unwrap_udt("raw_tf").alias("a"), F.unwrap_udt("tfidf").alias("b"))
    slots = both.select("doc_id", F.explode_outer(F.arrays_zip(F.col("a.indices").alias("slot"), F.col("a.values").alias("tf"), F.col("b.indices").alias("same"), F.col("b.values").alias("weight"))).alias("x")).select("doc_id", "x.*")
    freq = slots.where("tf > 0").groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    n = both.agg(F.count(F.lit(1)).cast("double")).scalar()
    idf = F.when(F.col("df") >= 5, F.log((n + 1.0) / (F.col("df") + 1.0))).otherwise(F.lit(0.0))
    fits = (F.col("slot") == F.col("same")) & (F.abs(F.col("weight") - F.col("tf") * idf) <= 1e-9 * (1 + F.abs("weight")))
    per_slot = slots.join(F.broadcast(freq), "slot", "left").select("doc_id", "tf", F.when(F.col("slot").isNotNull(), F.coalesce(fits, F.lit(False))).otherwise(True).alias("fits"))
    return per_slot.groupBy("doc_id").agg(F.coalesce(F.sum("tf"), F.lit(0.0)).alias("n_terms"), F.min("fits").alias("consistent"))


def _labelled_posts(spark, sf):
    return posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@query("assembled", "SELECT doc_id, 5013 AS width FROM documents")
def q_assembled(spark, sf):
    """Every row assembles (none skipped) into 13 features + 5000 hashed slots."""
    f = text_features(posts(spark, sf), "text", "summary", mode="ref")
    tf = vec.hashing_tf(vec.remove_stopwords(vec.tokenize(f, "text")), num_features=5000)
    a = vec.assembler(NUMERIC_FEATURES + ["raw_tf"]).transform(tf)
    return a.select("doc_id", vec.width_of(F.col("raw_features")).alias("width"))


@query("stages_full", """
SELECT d.doc_id, l.quality, 5014 AS width FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_stages_full(spark, sf):
    """All ten stages fitted; 13 features + group index + 5000 TF-IDF slots."""
    d = _labelled_posts(spark, sf).withColumnRenamed("lang", "group")
    model = fit_pipeline(vec.build_pipeline("text", "summary", "group", num_features=5000, include_group=True), d)
    return model.transform(d).select("doc_id", "quality", vec.width_of(F.col("features")).alias("width"))


@query("stages_simple")
def q_stages_simple(spark, sf):
    d = table(spark, sf, "documents")
    model = fit_pipeline(vec.build_simple_pipeline("text", num_features=5000), d)
    return model.transform(d).select("doc_id", "features")


def _catalog_sql() -> str:
    feats = ",\n       ".join(features_sql("text", _SUMMARY, "ref"))
    parts = [f"SELECT {i} AS \"index\", '{n}' AS name, '{c}' AS category, '{d}' AS description, "
             f"round(avg({n}), 6) AS mean, round(stddev_samp({n}), 6) AS stddev FROM f"
             for i, (n, c, d) in enumerate(vec.CATALOG)]
    return f"WITH f AS (SELECT {feats} FROM documents)\n" + "\nUNION ALL\n".join(parts)


@query("catalog", _catalog_sql())
def q_catalog(spark, sf):
    f = text_features(posts(spark, sf), "text", "summary", mode="ref")
    a = vec.assembler(NUMERIC_FEATURES).transform(f)
    return vec.feature_catalog(a, "raw_features")
