"""Shared pieces of the llm operators: reading tables, written intermediates, byte-level word kernels."""

from __future__ import annotations

import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.session import ensure_checkpoint_dir

#: Bytes of text that the word kernel handles at once (bounds its scratch memory).
SLICE_BYTES = 1 << 20

# The white space bytes of the word rule, x20 and x09-x0D.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (any file system that Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts lineage like ``checkpoint()``, survives lost executors, and keeps
    columns prunable for the reads that follow.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vireo-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def one_text(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``chosen`` (id and other columns) with a ``text`` each: of an id's texts the one with the smallest digest.

    ``chosen`` must be bounded, for it is broadcast; the result has a row at most for each of its rows, however
    often ``docs`` repeats an id.  Map tasks aggregate first, so a hot id sends one text a task.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return rows.groupBy(*chosen.columns).agg(F.min_by("text", F.sha2(F.col("text").cast("binary"), 256)).alias("text"))


def crc_remainder(value, modulus: int) -> int:
    """``id_remainder`` of one value in Python."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for what is dear to build (a loaded tokenizer)."""
    holder = sys.modules.setdefault("_vireo_llm_worker", types.ModuleType("_vireo_llm_worker"))
    return holder.__dict__.setdefault("cache", {})


# ---------------------------------------------------------------- integer mixing

def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64) on uint64 arrays, wrapping."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


# ---------------------------------------------------------------- words from Arrow text

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(WHITE_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(77))
_BYTE_LOWER = _BYTE[_LOWER]
_STEP = 0xD1342543DE82EF95
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Arrow strings as (bytes, offsets), nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_cuts(raw: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``size`` bytes that end at white space (a longer word extends its slice)."""
    at, n = 0, len(raw)
    while at < n:
        end = min(n, at + size)
        while end < n:
            white = np.flatnonzero(_IS_SPACE[raw[end:end + 4096]])
            if len(white):
                end += int(white[0]) + 1
                break
            end = min(n, end + 4096)
        yield at, end
        at = end


def word_hashes(column: pa.Array, lower: bool = False, prefixes: tuple[int, ...] = (), suffixes: tuple[int, ...] = ()):
    """(hash of every word, words per text[, hashes of each word's first or last k bytes for ``prefixes``, ``suffixes``]).

    A word is a run of bytes other than white space; with ``lower`` A-Z count
    as a-z.  Hashes are 64-bit polynomial hashes over random byte values,
    computed with prefix sums over slices, so whole texts of any length are
    covered with bounded scratch memory.
    """
    raw, off = text_buffers(column)
    values = _BYTE_LOWER if lower else _BYTE
    hashes, starts_all, short = [], [], [[] for _ in (*prefixes, *suffixes)]
    texts = len(off) - 1
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off] = True
    for lo, hi in text_cuts(raw, SLICE_BYTES):
        part = raw[lo:hi]
        white = _IS_SPACE[part]
        first = ~white
        last = first.copy()
        first[1:] &= white[:-1] | edge[lo + 1:hi]
        last[:-1] &= white[1:] | edge[lo + 1:hi]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        n = hi - lo
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(values[part] * _power(_STEP, n)[:n], out=total[1:])
            back = _power(_STEP_INVERSE, n)[s]
            size = (e - s).astype(np.uint64)
            hashes.append(mix64((total[e] - total[s]) * back ^ (size << np.uint64(48))))
            for k, into in zip(prefixes, short):
                cut = np.minimum(s + k, e)
                into.append(mix64((total[cut] - total[s]) * back + np.uint64(1_000_003 * (k + 1))))
            for k, into in zip(suffixes, short[len(prefixes):]):
                cut = np.maximum(e - k, s)
                into.append(mix64((total[e] - total[cut]) * _power(_STEP_INVERSE, n)[cut] + np.uint64(2_000_003 * (k + 1))))
        starts_all.append(s + lo)
    if not hashes:
        empty = np.zeros(0, np.uint64)
        return empty, np.zeros(texts, np.int64), *[empty for _ in short]
    starts = np.concatenate(starts_all)
    counts = np.diff(np.searchsorted(starts, off))
    return np.concatenate(hashes), counts, *[np.concatenate(x) for x in short]


def word_counts(column: pa.Array) -> np.ndarray:
    """Words per text."""
    raw, off = text_buffers(column)
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off] = True
    starts = [np.zeros(0, np.int64)]
    for lo, hi in text_cuts(raw, SLICE_BYTES):
        white = _IS_SPACE[raw[lo:hi]]
        first = ~white
        first[1:] &= white[:-1] | edge[lo + 1:hi]
        starts.append(np.flatnonzero(first) + lo)
    return np.diff(np.searchsorted(np.concatenate(starts), off))


def within(counts: np.ndarray) -> np.ndarray:
    """For group sizes, the index of every member inside its group."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows whose texts take about ``limit`` bytes (one row at least)."""
    sizes = np.diff(text_buffers(batch.column(batch.schema.get_field_index(column)))[1])
    at = 0
    while at < batch.num_rows:
        total = np.cumsum(sizes[at:at + 100_000])
        n = max(1, int(np.searchsorted(total, limit, "right")))
        yield batch.slice(at, n)
        at += n
