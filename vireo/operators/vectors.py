"""Token, term-statistics and vector operators.

Two forms of the same numbers:

* ML form -- ``Tokenizer``, ``StopWordsRemover``, ``HashingTF``, ``IDF``,
  ``StringIndexer``, ``VectorAssembler``, ``StandardScaler`` in a
  ``Pipeline`` (fit on the training part only);
* long form -- ``(doc, term, tf, df, idf, tfidf)`` tables built with explode
  and grouped aggregates, which SQL can check and which shows the shuffles:
  (doc, term) counts are partially aggregated before the shuffle, and the
  per-term table is joined back with the size-checked join that takes hot keys apart, so a
  term that occurs in a third of all documents is not one task.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import (HashingTF, IDF, StandardScaler, StopWordsRemover, StringIndexer,
                                Tokenizer, VectorAssembler)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.functions.rows import rows_from
from vireo.functions.stopwords import ENGLISH
from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators.cumulative import row_numbers
from vireo.operators.features import SummaryFeatures, TextFeatures, unique_word_ratio_stage
from vireo.operators.joins import MAX_BROADCAST_BYTES, join_group_table, materialize

# Fixed value: sklearn's default token rule "\b\w\w+\b" with \w spelled as
# letters, digits and underscore, so Java regex and RE2 agree.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Fixed value: the characters Java's \s matches (the Tokenizer's split).
JAVA_SPACE = r"[ \t\n\x{0B}\f\r]"


def stop_words(languages: tuple[str, ...] = ("english",)) -> list[str]:
    """Union of Spark's default lists for ``languages`` (english needs no JVM)."""
    words: list[str] = []
    for lang in languages:
        if lang == "english":
            words += ENGLISH
        else:
            words += StopWordsRemover.loadDefaultStopWords(lang)
    return list(dict.fromkeys(words))


def tokenize(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Lower-case and split on each whitespace character (Tokenizer); a null text counts as empty."""
    filled = df.withColumn(col, F.coalesce(F.col(col), F.lit("")))
    return Tokenizer(inputCol=col, outputCol=out).transform(filled)


def remove_stopwords(df: DataFrame, col: str = "words", out: str = "filtered_words",
                     languages: tuple[str, ...] = ("english",)) -> DataFrame:
    """Drop stop words of ``languages`` (case-insensitive)."""
    return StopWordsRemover(inputCol=col, outputCol=out, stopWords=stop_words(languages)).transform(df)


def hashing_tf(df: DataFrame, col: str = "filtered_words", out: str = "raw_tf",
               num_features: int = 5000) -> DataFrame:
    """Hashed term counts of fixed width (murmur3 buckets)."""
    return HashingTF(inputCol=col, outputCol=out, numFeatures=num_features).transform(df)


def fit_idf(df: DataFrame, col: str = "raw_tf", out: str = "tfidf", min_doc_freq: int = 5):
    """``IDF`` model, idf = ln((N+1)/(df+1)), 0 below ``min_doc_freq``."""
    return IDF(inputCol=col, outputCol=out, minDocFreq=min_doc_freq).fit(df)


def term_counts(df: DataFrame, id_col: str, text_col: str, tokens: Column,
                languages: tuple[str, ...] | None = ("english",)) -> DataFrame:
    """``(id, term, tf)`` from a token-array expression, stored; empty tokens and
    stop words are dropped after the explode (a hash-set ``InSet`` test per token).

    The texts are dealt by id first, to a fixed number of tasks, and split there: a text is smaller
    than its token array, every core splits, and the (id, term) count needs no further shuffle.
    What follows reads the stored counts.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ex = df.select(id_col, text_col).repartition(tasks, id_col).select(id_col, F.explode(tokens).alias("term"))
    cond = F.col("term") != ""
    if languages:
        cond = cond & ~F.col("term").isin(stop_words(languages))
    return materialize(ex.where(cond).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def spark_tokens(text: Column) -> Column:
    """The Tokenizer's tokens as an array expression (lower, split on each
    whitespace character)."""
    return F.split(F.lower(text), JAVA_SPACE)


def word_tokens(text: Column) -> Column:
    """sklearn-style tokens: lower-cased runs of 2+ word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), 0)


def term_stats(df: DataFrame, id_col: str, text_col: str, min_doc_freq: int = 0,
               languages: tuple[str, ...] | None = ("english",),
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(id, term, tf, df, idf, tfidf)`` with Spark IDF semantics."""
    tf = term_counts(df, id_col, text_col, spark_tokens(F.col(text_col)), languages)
    n_docs = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    dfs = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    rows = join_group_table(tf, dfs, ["term"], how="inner", size_col="df", max_broadcast_bytes=max_broadcast_bytes)
    idf = F.when(F.col("df") >= min_doc_freq,
                 F.log((n_docs + 1.0) / (F.col("df") + 1.0))).otherwise(F.lit(0.0))
    return rows.select(id_col, "term", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def vocab_tfidf(df: DataFrame, id_col: str, text_col: str, max_features: int = 5000,
                min_df: int = 5, max_df: float = 0.8,
                languages: tuple[str, ...] | None = ("english",)) -> DataFrame:
    """E5: vocabulary TF-IDF in sklearn's documented form, long format.

    vocabulary: terms with ``min_df <= df <= max_df * N``, top ``max_features``
    by corpus count (ties by term); idf = ln((1+N)/(1+df)) + 1; each document
    row L2-normalised over its kept terms.  The vocabulary has at most
    ``max_features`` rows, and its bytes decide whether it is broadcast.
    """
    tf = term_counts(df, id_col, text_col, word_tokens(F.col(text_col)), languages)
    n_docs = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    per_term = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    kept = per_term.where((F.col("df") >= min_df) & (F.col("df") <= n_docs * max_df))
    vocab = kept.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    vocab = materialize(vocab.select("term", (F.log((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")))
    raw = join_group_table(tf, vocab, ["term"], how="inner").select(id_col, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("w") / norm).alias("tfidf"))


def group_index_table(df: DataFrame, col: str) -> DataFrame:
    """E7 in table form: ``(group, n, index)``, frequency desc, ties by name;
    a null group gets the extra index after all named groups (``keep``)."""
    sizes = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    named = sizes.where(F.col(col).isNotNull())
    # ranked over range partitions of the group table
    idx = row_numbers(named, [F.desc("n"), F.asc(col)], "__row").select(col, "n", (F.col("__row") - 1).cast("double").alias("index"))
    n_named = named.agg(F.count(F.lit(1)).cast("double")).scalar()
    nulls = sizes.where(F.col(col).isNull()).select(col, "n", n_named.alias("index"))
    return idx.unionByName(nulls)


def index_group(col: str, out: str = "group_index") -> StringIndexer:
    """E7 as a stage: StringIndexer, frequency order, unseen/null kept."""
    return StringIndexer(inputCol=col, outputCol=out, handleInvalid="keep",
                         stringOrderType="frequencyDesc")


def assembler(cols: list[str], out: str = "raw_features") -> VectorAssembler:
    """One vector from numeric columns and vectors; invalid rows skipped."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip")


def scaler(col: str = "raw_features", out: str = "features") -> StandardScaler:
    """Divide by sample stddev, no centring (sparse-safe)."""
    return StandardScaler(inputCol=col, outputCol=out, withStd=True, withMean=False)


def scale_columns(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """E9 in column form: x / stddev_samp(x), 0 where the stddev is 0."""
    sd = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols])
    out = [F.col(k) for k in (keep or [])]
    for c in cols:
        s = sd.select(c).scalar()
        out.append(F.when(s > 0, F.col(c).cast("double") / s).otherwise(F.lit(0.0)).alias(c))
    return df.select(*out)


def build_pipeline(text_col: str = "text", summary_col: str = "summary", group_col: str | None = "group",
                   num_features: int = 5000, min_doc_freq: int = 5, include_group: bool = False,
                   mode: str = "ref", languages: tuple[str, ...] = ("english",)) -> Pipeline:
    """Text -> summary -> index -> tokens -> stop words -> TF -> IDF ->
    assemble -> scale.  The group index is fitted and assembled only with
    ``include_group`` (it leaks an activity label built from group size).  Null
    text and summaries count as empty in every stage.
    Fit it on the training part only."""
    stages = [TextFeatures(inputCol=text_col, mode=mode), SummaryFeatures(inputCol=summary_col)]
    inputs = list(NUMERIC_FEATURES)
    if group_col and include_group:
        stages.append(index_group(group_col, "group_index"))
        # strip the nominal metadata so tree learners do not need maxBins >= #groups
        stages.append(_numeric_copy("group_index", "group_index_num"))
        inputs.append("group_index_num")
    stages += [Tokenizer(inputCol=text_col, outputCol="words"),
               StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=stop_words(languages)),
               HashingTF(inputCol="filtered_words", outputCol="raw_tf", numFeatures=num_features),
               IDF(inputCol="raw_tf", outputCol="tfidf", minDocFreq=min_doc_freq)]
    inputs.append("tfidf")
    stages += [assembler(inputs, "raw_features"), scaler("raw_features", "features")]
    return Pipeline(stages=stages)


def filled_column(col: str):
    """A stage that puts '' for null in ``col``."""
    from pyspark.ml.feature import SQLTransformer
    return SQLTransformer(statement=f"SELECT * EXCEPT (`{col}`), coalesce(`{col}`, '') AS `{col}` FROM __THIS__")


def _numeric_copy(col: str, out: str):
    from pyspark.ml.feature import SQLTransformer
    return SQLTransformer(statement=f"SELECT *, CAST(`{col}` AS DOUBLE) + 0.0 AS `{out}` FROM __THIS__")


def build_simple_pipeline(text_col: str = "text", num_features: int = 5000,
                          min_doc_freq: int = 5) -> Pipeline:
    """Tokens -> stop words -> hashed TF -> IDF."""
    return Pipeline(stages=[
        filled_column(text_col), Tokenizer(inputCol=text_col, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=stop_words()),
        HashingTF(inputCol="filtered_words", outputCol="raw_tf", numFeatures=num_features),
        IDF(inputCol="raw_tf", outputCol="features", minDocFreq=min_doc_freq)])


# The feature catalogue: category and description per feature.
CATALOG = [
    ("char_count", "length", "Total character count of the text"),
    ("word_count", "length", "Number of words"),
    ("sentence_count", "structure", "Approximate number of sentences"),
    ("avg_word_length", "length", "Average word length"),
    ("unique_word_ratio", "vocabulary", "Distinct words over words"),
    ("question_count", "punctuation", "Number of question marks"),
    ("exclamation_count", "punctuation", "Number of exclamation marks"),
    ("uppercase_ratio", "style", "Share of upper-case characters"),
    ("has_url", "content", "Text contains a URL"),
    ("paragraph_count", "structure", "Number of blank-line separated paragraphs"),
    ("summary_length", "summary", "Character count of the summary"),
    ("summary_word_count", "summary", "Word count of the summary"),
    ("content_density", "summary", "Summary length over text length"),
]


def feature_catalog(assembled: DataFrame, vector_col: str = "raw_features") -> DataFrame:
    """``(index, name, category, description, mean, stddev)`` for the
    named (non-hashed) slots of an assembled vector, from its ML attribute
    metadata; statistics come from the data in one aggregate."""
    meta = assembled.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for kind in meta.values() for a in kind)
    info = {n: (c, d) for n, c, d in CATALOG}
    named = [(i, n) for i, n in slots if n in info]
    stats = assembled.agg(*[F.avg(n).alias(f"m{i}") for i, n in named],
                          *[F.stddev_samp(n).alias(f"s{i}") for i, n in named])
    return rows_from(stats, [{"index": F.lit(i), "name": F.lit(n), "category": F.lit(info[n][0]),
                              "description": F.lit(info[n][1]), "mean": F.round(f"m{i}", 6),
                              "stddev": F.round(f"s{i}", 6)} for i, n in named])


def width_of(vec: Column) -> Column:
    """Vector width without a Python UDF."""
    from pyspark.ml.functions import vector_to_array
    return F.size(vector_to_array(vec))


def idf_value(n_docs: float, df_: float, min_doc_freq: int = 0) -> float:
    """Reference value of Spark's IDF for tests."""
    return 0.0 if df_ < min_doc_freq else math.log((n_docs + 1.0) / (df_ + 1.0))


__all__ = ["tokenize", "remove_stopwords", "hashing_tf", "fit_idf", "term_stats", "vocab_tfidf",
           "group_index_table", "index_group", "assembler", "scaler", "scale_columns",
           "build_pipeline", "build_simple_pipeline", "feature_catalog", "stop_words",
           "unique_word_ratio_stage"]
