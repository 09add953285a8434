"""File sources and sinks: CSV, Parquet, partitioned tables,
storage reports and small result marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.functions.hashing import key_uniform
from vireo.operators.joins import materialize, row_bytes

# Fixed value: the post schema of the source CSV (8 nullable strings).
POST_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in
                            ["author", "body", "normalizedBody", "subreddit", "subreddit_id", "id",
                             "content", "summary"]])

ROWS_PER_FILE = 1_000_000
# Values in one file, before encoding: what one task writes, and reads where a file cannot be split.
BYTES_PER_FILE = 64 << 20
# How CSV files written here mark a null; an empty string stays an empty string.
CSV_NULL = "\\N"


def _csv(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .option("nullValue", CSV_NULL).option("emptyValue", ""))


def read_posts_csv(spark: SparkSession, path: str, schema: T.StructType = POST_SCHEMA) -> DataFrame:
    """A1: header CSV with an explicit schema, embedded newlines, and '"' as
    both quote and escape.  A multi-line file is one task per file (not
    splittable): write many files upstream for parallelism."""
    return _csv(spark, True).schema(schema).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = True,
                      corrupt_col: str = "_corrupt_record") -> DataFrame:
    """A2: header CSV with schema inference, PERMISSIVE mode, and a
    ``corrupt_col`` that holds the raw record of every row that does not fit
    the inferred schema (so bad rows are counted, not silently nulled).
    Inference is an extra pass over the data; prefer A1 in production."""
    reader = _csv(spark, multi_line)
    inferred = reader.option("inferSchema", True).csv(path).schema
    schema = T.StructType(inferred.fields + [T.StructField(corrupt_col, T.StringType(), True)])
    return (reader.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col).csv(path))


def bad_rows(df: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Rows of a PERMISSIVE read that did not parse."""
    return df.where(F.col(corrupt_col).isNotNull())


def bad_row_count(df: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """One row ``(rows, bad_rows)``; both counts reference every column, so
    the scan parses whole records (Spark refuses scans that reference only
    the corrupt-record column)."""
    others = [F.col(c).cast("string") for c in df.columns if c != corrupt_col]
    # always true, but it makes the scan parse every field of every record
    parsed = F.length(F.concat_ws("\u0000", *others)) >= 0
    return df.agg(F.count_if(parsed).alias("rows"),
                  F.count_if(parsed & F.col(corrupt_col).isNotNull()).alias("bad_rows"))


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType = POST_SCHEMA,
                   bad: str = "drop", corrupt_col: str = "_corrupt_record") -> DataFrame:
    """A3: single-line records (splittable), malformed lines dropped
    (``bad='drop'``), kept with their raw text in ``corrupt_col`` (``'keep'``), or an error (``'fail'``).

    Every record is parsed whole whatever columns are read later, so a line is malformed or not
    independently of the query; ``bad_row_count`` on a ``'keep'`` read tells how many there are.
    """
    reader = _csv(spark, False).option("columnPruning", False)
    if bad == "fail":
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    whole = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)])
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col).schema(whole).csv(path)
    if bad == "keep":
        return rows
    # the condition reads every column, which keeps the scan from parsing less than the record
    parsed = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0
    return rows.where(parsed & F.col(corrupt_col).isNull()).drop(corrupt_col)


def file_count(df: DataFrame, least: int = 1, bytes_per_file: int = BYTES_PER_FILE) -> int:
    """How many files of about ``bytes_per_file`` the rows of ``df`` fill, ``least`` or more."""
    return max(least, -(-(df.agg(F.sum(row_bytes(df))).first()[0] or 0) // bytes_per_file))


def write_csv(df: DataFrame, path: str, bytes_per_file: int = BYTES_PER_FILE) -> None:
    """CSV writer that keeps values byte-exact (no whitespace trimming; null is written
    as ``CSV_NULL``, an empty string as ""), with the same quote/escape convention as A1.

    Multi-line files cannot be split by their readers, so a task's rows are cut into files of about ``bytes_per_file``."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    rows_per_file = max(1, n * bytes_per_file // max(size or 0, 1))
    (df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("header", True).option("quote", '"').option("escape", '"').option("nullValue", CSV_NULL)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_parquet(spark: SparkSession, path: str, fraction: float | None = None,
                 key: str | None = None, seed: int = 42) -> DataFrame:
    """A4: Parquet scan; with ``fraction`` a reproducible hash sample by ``key``."""
    df = spark.read.parquet(path)
    if fraction is not None and fraction < 1.0:
        if key is None:
            raise ValueError("a sample needs a key column")
        df = df.where(key_uniform(F.col(key), seed) < F.lit(float(fraction)))
    return df


def write_parquet(df: DataFrame, path: str) -> None:
    """A5: overwrite, snappy."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str] | str, rows_per_file: int = ROWS_PER_FILE,
                      bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Parquet partitioned by ``by``, about ``rows_per_file`` rows or ``bytes_per_file`` of values to a file, whichever is less.

    The rows and bytes of each partition value are summed first; a value is then written by as many
    tasks as it fills files, its rows dealt by a hash of all their columns, so writers grow
    with the table, a value (or the null value) with a third of all rows isn't one task, and a task that runs
    again deals its rows as before.
    """
    cols = [by] if isinstance(by, str) else list(by)
    files = materialize(df.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(cols)])
                        .agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)), F.ceil(F.sum(row_bytes(df)) / F.lit(bytes_per_file))).cast("int").alias("__files")))
    total = files.agg(F.sum("__files")).first()[0] or 1
    on = F.lit(True)
    for i, c in enumerate(cols):
        on = on & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = df.join(files, on, "left").withColumn("__part", F.pmod(F.xxhash64(*hashed), F.col("__files")))
    (dealt.repartition(max(total, 1), *[F.col(c) for c in cols], "__part").select(*df.columns).write.mode("overwrite")
     .option("compression", "snappy").option("maxRecordsPerFile", 2 * rows_per_file).partitionBy(*cols).parquet(path))


def read_partition(spark: SparkSession, path: str, where) -> DataFrame:
    """A6 pruned read: a filter on partition columns becomes
    ``PartitionFilters`` in the scan, so other directories are never listed
    for data."""
    return spark.read.parquet(path).where(where)


def storage_report(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Files, bytes and rows per partition value of a file-backed frame,
    from the hidden ``_metadata`` column (no driver-side file listing), plus
    the in-memory text size over stored bytes as a compression ratio."""
    by = by or []
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in by]
    raw = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in str_cols), F.lit(0))
    rows = df.select(*by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                     raw.alias("raw"))
    per_file = rows.groupBy(*by, "file").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("rows"),
                                            F.sum("raw").alias("raw"))
    out = per_file.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
                                    F.sum("rows").alias("rows"), F.sum("raw").alias("text_bytes"))
    return out.withColumn("compression_ratio", F.round(F.col("text_bytes") / F.nullif(F.col("bytes"), F.lit(0)), 3))


def write_mart(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """A result table as header CSV: one file while it is small, else as many files as its rows need.

    The plan runs once, into a stored table; only that is counted and dealt to files.
    """
    stored = materialize(df)
    write_csv(stored.repartition(max(1, -(-stored.count() // rows_per_file))), path)


def read_mart(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = _csv(spark, True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """A10: keep label, prediction, probability, rawPrediction (+ any id)."""
    keep = [c for c in ("id", "doc_id", "label", "prediction", "probability", "rawPrediction") if c in df.columns]
    write_parquet(df.select(*keep), path)
