"""Text features as staged projections, plus the pipeline-stage wrappers.

``text_features`` emits all 13 features through a few ``select``s of
built-in expressions (each costly intermediate -- a regex split, a distinct
count -- computed once and referenced by name), fused with the scan in one
codegen stage: no Python worker, no chain of ``withColumn`` plan nodes.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.functions import text as tx
from vireo.operators.parallel import spread

BODY_FEATURES = tx.NUMERIC_FEATURES[:10]
SUMMARY_FEATURES = tx.NUMERIC_FEATURES[10:]


def text_features(df: DataFrame, text_col: str, summary_col: str | None = None,
                  mode: str = "ref", float32: bool = False,
                  features: list[str] | None = None) -> DataFrame:
    """``df`` plus the 13 features of ``mode`` ('ref'|'script'|'words').

    Without a summary column the summary features use ''.  ``float32`` casts
    like the reference transformer does.  The projections are fused with
    the scan in one codegen stage; an under-split input is spread over the
    cluster first (see ``parallel.spread``).
    """
    summary = F.col(summary_col) if summary_col else F.lit(None).cast("string")
    stages = tx.feature_stages(F.col(text_col), summary, mode)
    wanted = features or tx.NUMERIC_FEATURES
    out_type = "float" if float32 else "double"
    existing = [c for c in df.columns if c not in wanted]
    cur = spread(df)
    carried: list[str] = []
    for stage in stages[:-1]:
        cur = cur.select(*existing, *carried, *[e.alias(n) for n, e in stage.items()])
        carried += list(stage)
    final = stages[-1]
    return cur.select(*existing, *[final[n].cast(out_type).alias(n) for n in wanted])


def summary_features(df: DataFrame, summary_col: str, char_count_col: str = "char_count") -> DataFrame:
    """D11-D13 from a summary column and an upstream ``char_count``."""
    if char_count_col not in df.columns:
        raise ValueError(f"summary features need '{char_count_col}' from the text features first")
    s = F.coalesce(F.col(summary_col), F.lit(""))
    sl = F.length(s)
    return df.select(*[c for c in df.columns if c not in tx.NUMERIC_FEATURES[10:]],
                     sl.cast("double").alias("summary_length"),
                     tx.split_count(s, tx.WORD_SPLIT).cast("double").alias("summary_word_count"),
                     tx.ratio_or_zero(sl, F.col(char_count_col)).alias("content_density"))


def unique_word_ratio_stage(text_col: str) -> SQLTransformer:
    """The SQL stage, with the text column actually substituted."""
    return SQLTransformer(statement=(
        "SELECT *, CASE WHEN word_count > 0 "
        f"THEN CAST(size(array_distinct(split(`{text_col}`, ' '))) AS DOUBLE) / word_count "
        "ELSE 0.0 END AS unique_word_ratio FROM __THIS__"))


def eda_features(df: DataFrame, text_col: str, summary_col: str | None, label_col: str) -> DataFrame:
    """body_length, summary_length, word_count, has_url, question and
    exclamation marks, label -- the exploratory feature table."""
    t = F.col(text_col)
    s = F.col(summary_col) if summary_col else F.lit(None).cast("string")
    return df.select(
        F.length(t).alias("body_length"),
        F.length(s).alias("summary_length"),
        tx.split_count(t, tx.WORD_SPLIT).alias("word_count"),
        F.when(t.rlike(tx.EDA_URL_PATTERN), 1).otherwise(0).alias("has_url"),
        tx.char_occurrences(t, "?").cast("int").alias("question_marks"),
        tx.char_occurrences(t, "!").cast("int").alias("exclamation_marks"),
        F.col(label_col).alias(label_col),
    )


class TextFeatures(Transformer, HasInputCol, HasOutputCol,
                   DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage for the 10 body features (plus unique_word_ratio,
    which the original docstring promised).  Columns have fixed names."""

    mode = Param(Params._dummy(), "mode", "ref | script | words", typeConverter=TypeConverters.toString)
    float32 = Param(Params._dummy(), "float32", "cast features to float", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol: str = "text", outputCol: str = "text_features",
                 mode: str = "ref", float32: bool = False):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="text_features", mode="ref", float32=False)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        col = self.getInputCol()
        filled = df.withColumn(col, F.coalesce(F.col(col), F.lit("")))  # later stages read it too
        return text_features(filled, col, None, self.getOrDefault(self.mode),
                             self.getOrDefault(self.float32), features=BODY_FEATURES)


class SummaryFeatures(Transformer, HasInputCol, HasOutputCol,
                      DefaultParamsReadable, DefaultParamsWritable):
    """summary_length, summary_word_count, content_density; needs
    ``char_count`` upstream."""

    @keyword_only
    def __init__(self, inputCol: str = "summary", outputCol: str = "summary_features"):
        super().__init__()
        self._setDefault(inputCol="summary", outputCol="summary_features")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        col = self.getInputCol()
        return summary_features(df.withColumn(col, F.coalesce(F.col(col), F.lit(""))), col)
