"""The corpus pipeline: five stages over ``documents``, each calling one llm operator.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns a DataFrame that is written as Parquet and read again for the next one.
All but the last return the columns of ``documents``; ``n_chars`` follows the text.

quality          documents that the compression classifier scores below 0.7 go
near_duplicates  of each group of near copies one row stays, of the smallest doc_id
secrets          every secret found in a text is replaced by [SECRET]
mixing           sources are brought to their target weights; a document taken in a
                 second pass stands twice, one taken in part keeps its taken blocks
packing          pieces of at most 1024 tokens with their place in a sequence

Nulls: a null text counts as empty (it has no words, so mixing takes nothing of it);
a null doc_id counts as the largest in the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import mixing, near_dup, packing, secrets, zstd_quality
from vireo.llm.common import id_remainder, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = zstd_quality.fit(docs, table(spark, sf_dir, "labels").where(id_remainder("doc_id", 4) != 2))
    return zstd_quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_representatives(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: No stage but the last could be told in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
