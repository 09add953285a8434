"""Operator 10: mixing sources to target weights.

Each source's words form one stream, cut into blocks of ``BLOCK`` words.  The
weights share a budget of words; no source goes above ``MOST`` times its size
(the excess is reshared).  A source's target becomes a number of block slots.
Every source deals its slots to the output shards by
multinomial draws, first to groups of shards, then inside each group to its shards, seeded by
the source and the group, so the draws add up to the source's slots exactly, no task needs to know
all sources, and a rerun gives the same mix.  Slot i of a source holds
block perm(i mod blocks), where perm is a keyed pseudorandom permutation of
the source's block indices (a Feistel network with cycle walking); slots and
blocks are then joined by (source, block).  As slots are at most ``MOST`` times
the blocks, no document is taken more than ``MOST`` times.

Order inside a stream: hash chunks of ids, then id; running sums inside a chunk,
and a window over the chunks' totals, give every document its first word, so a
source that holds a third of all rows is spread over many tasks.

The table of sources stays distributed, however many there are: sources are ranked over range
partitions, and the level of the budget per unit of weight is found from sums per weight class.
Rows meet their source's row by a size-checked join that takes hot sources apart.

Defined cases: null text is empty and has size 0; the null source is a source of
its own, ranked last; sources without words have target 0; repeated rows are rows
of their own; an empty table gives an empty result; extra columns don't clash, as
only the named ones are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import WORD, byte_slices, mix64, stored, word_counts
from vireo.operators.cumulative import below_sums, row_numbers
from vireo.operators.joins import join_group_table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK = 64
SHARD_SLOTS = 65_536
CHUNK_DOCS = 4096
SEED = 11
_WORD = re.compile(WORD)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, with_text: bool = False) -> DataFrame:
    """Stored (row, id, source, size[, text]): the words of every row's text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(word_counts(batch.column(2))), *[batch.column(2)] * with_text], ["id", "source", "size"] + ["text"] * with_text)

    counted = (docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
               .mapInArrow(count, f"id {id_type}, source string, size long{', text string' * with_text}"))
    return stored(counted.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def level(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> float:
    """Words per unit of weight: sources get level x weight, at most ``most`` times their size, together ``share`` of all words.

    Starting from no capped source the level only rises, and a source that is above its cap once stays so.
    Each step is one pass over the table; sizes and counts are whole numbers, so the level doesn't depend on the partitioning.
    """
    total = sources.agg(F.sum("size")).first()[0] or 0
    found, capped = 0.0, -1
    while True:
        over = F.lit(found) * F.col("weight") > F.lit(most) * F.col("size")
        free = [F.count_if(~over & (F.col("class") == i)) for i in range(len(weights))]
        capped_now, words, *counts = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("size"))), F.lit(0)), *free).first()
        weight = sum(w * n for w, n in zip(weights, counts))
        if capped_now == capped or not weight:
            return found
        found, capped = (share * total - most * words) / weight, capped_now


def source_table(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """Stored, one row per source: key, source_id (rank by code point, null last), rows, size, weight, target, blocks and slots."""
    found = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
    ranked = row_numbers(found, [F.col("source").isNull(), F.col("source")], "rank")
    listed = stored(ranked.select(_key(), (F.col("rank") - 1).cast("long").alias("source_id"), "rows", "size",
                                  ((F.col("rank") - 1) % len(weights)).cast("int").alias("class"))
                    .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1)), "mix-source-sizes")
    target = F.least(F.lit(level(listed, weights, share, most)) * F.col("weight"), F.lit(most) * F.col("size"))
    sized_ = listed.withColumn("target", target).withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("long"))
    slots = F.when(F.col("size") > 0, F.least(F.rint(F.col("target") / (F.col("size") / F.col("blocks"))), F.floor(F.lit(most) * F.col("blocks")))).otherwise(0)
    return stored(sized_.withColumn("slots", slots.cast("long")), "mix-sources")


def _key():
    """The source as a join key: null is a key of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key")


def deal(count: int, sizes: np.ndarray, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(first, number) of ``count`` things that each part gets, drawn in proportion to ``sizes``."""
    drawn = np.random.Generator(np.random.Philox(np.random.SeedSequence(seed))).multinomial(count, sizes / sizes.sum())
    return np.cumsum(drawn) - drawn, drawn


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..size-1, elementwise: four Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    bound = size.astype(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix64(right + k * np.uint64(0x10001) + (np.uint64(r) << np.uint64(56))) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= bound[todo]]
    return out.astype(np.int64)


def slot_table(sources: DataFrame, seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as block references: shard, source_id, block, pass (how often the source was gone through before)."""
    shards = max(1, -(-(sources.agg(F.sum("slots")).first()[0] or 0) // shard_slots))
    per = math.isqrt(shards - 1) + 1
    groups = np.diff(np.append(np.arange(0, shards, per), shards))
    tasks = min(shards, 10_000)

    def dealt(step: int, frame: pd.DataFrame) -> pd.DataFrame:
        """Each row's slots [first, first + count) dealt on: to groups of shards, then inside its group to shards."""
        parts = []
        for source, blocks, at, first, count in frame.itertuples(index=False):
            begin, drawn = deal(count, groups if step == 0 else np.ones(groups[at]), [seed, step, source, at])
            some = np.flatnonzero(drawn)
            parts.append(pd.DataFrame({"source_id": source, "blocks": blocks, "at": some + (at * per if step else 0), "first": first + begin[some], "count": drawn[some]}))
            if sum(map(len, parts)) >= 65_536 or len(parts) >= 1024:
                yield pd.concat(parts)
                parts = []
        if parts:
            yield pd.concat(parts)

    def to_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from dealt(0, frame)

    def to_shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from dealt(1, frame)

    def to_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lo = 0
            while lo < len(frame):
                # rows with about a shard's slots at a time
                hi = lo + max(1, int(np.searchsorted(np.cumsum(frame["count"].to_numpy()[lo:]), shard_slots, "right")))
                part = frame.iloc[lo:hi]
                count = part["count"].to_numpy()
                source, size = np.repeat(part["source_id"].to_numpy(), count), np.repeat(part["blocks"].to_numpy(), count)
                nth = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(part["first"].to_numpy(), count)
                block = permute(nth % size, size, mix64(source.astype(np.uint64) + np.uint64(seed << 32)))
                yield pd.DataFrame({"shard": np.repeat(part["at"].to_numpy(), count), "source_id": source, "block": block, "pass": (nth // size).astype(np.int32)})
                lo = hi

    row = "source_id long, blocks long, at long, first long, count long"
    drawn = (sources.where("slots > 0").select("source_id", "blocks", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("first"), F.col("slots").alias("count"))
             .mapInPandas(to_groups, row).repartition(tasks, "source_id", "at").mapInPandas(to_shards, row))
    return drawn.repartition(tasks, "at").mapInPandas(to_blocks, "shard long, source_id long, block long, pass int")


def placed_blocks(rows: DataFrame, sources: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows with source_id and their first word in the source's stream, one row per (row, block) that they share)."""
    listed = sources.select("key", "source_id", "rows")
    known = join_group_table(rows.withColumn("key", _key()), listed, ["key"], size_col="rows").drop("key", "source", "rows")
    chunks = max(1, -(-(sources.agg(F.sum("rows")).first()[0] or 0) // CHUNK_DOCS))
    known = known.withColumn("chunk", F.pmod(F.xxhash64("id", "row"), F.lit(chunks)))
    inside = known.withColumn("inside", F.sum("size").over(Window.partitionBy("source_id", "chunk").orderBy("id", "row")) - F.col("size"))
    totals = known.groupBy("source_id", "chunk").agg(F.sum("size").alias("words"))
    before = below_sums(totals, "chunk", ["words"], ["source_id"]).select("source_id", "chunk", "below_words")
    placed = inside.join(before, ["source_id", "chunk"]).withColumn("first", F.col("inside") + F.col("below_words")).drop("inside", "below_words", "chunk")
    last = F.greatest(F.col("first") + F.col("size") - 1, F.col("first"))
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(last / block))))
    begin = F.greatest(F.col("first"), F.col("block") * block)
    end = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block)
    return placed, pieces.select("row", "source_id", "block", (begin - F.col("first")).alias("from_word"), (end - begin).alias("words"), "id", "size")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the mix: one row per slot and document in its block, all documents' blocks, the table of sources)."""
    rows = sized(docs, id_col, text_col, source_col)
    sources = source_table(rows, weights, share, most, block)
    _, pieces = placed_blocks(rows, sources, block)
    # slots come from a small table of sources, so the planner must be told that they aren't few
    return slot_table(sources, seed).hint("merge").join(pieces, ["source_id", "block"]), pieces, sources


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: what the mix takes of every document."""
    rows = sized(docs, "doc_id", "text", "source")
    sources = source_table(rows)
    _, pieces = placed_blocks(rows, sources)
    times = slot_table(sources).groupBy("source_id", "block").agg(F.count("*").alias("times"))
    taken = (pieces.join(times.hint("merge"), ["source_id", "block"], "left").groupBy("row", "source_id", "id", "size")
             .agg(F.sum(F.coalesce("times", F.lit(0)) * F.col("words")).alias("taken")))
    facts = sources.select("source_id", F.col("size").alias("source_size"), "target", "rows")
    return join_group_table(taken, facts, ["source_id"], size_col="rows").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _cut_words(text: str, ranges: list[tuple[int, int]]) -> str:
    """The words [a, b) of ``text`` for sorted ranges; neighbours merge, and a merged run keeps its white space."""
    merged: list[list[int]] = []
    for a, n in ranges:
        if merged and merged[-1][1] == a:
            merged[-1][1] = a + n
        else:
            merged.append([a, a + n])
    spans = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in merged)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix as documents: for every pass over a source, each document that has blocks taken in it gives one row.

    A document whose blocks are all taken keeps its text as it is; else the text is
    its taken words in order.  Other columns stay; rows without words give nothing.
    """
    schema = docs.schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array(word_counts(batch.column(batch.schema.get_field_index(text_col)).cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], [*batch.schema.names, "__mix_size"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    kept = stored(docs.mapInArrow(count, f"{fields}, __mix_size long").withColumn("__mix_row", F.monotonically_increasing_id()), "mix-documents")
    rows = kept.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col("__mix_size").alias("size"), F.col("__mix_row").alias("row"))
    sources = source_table(rows, weights, share, most, block)
    _, pieces = placed_blocks(rows, sources, block)
    taken = (slot_table(sources, seed).hint("merge").join(pieces.where("words > 0"), ["source_id", "block"]).groupBy(F.col("row").alias("__mix_row"), "pass")
             .agg(F.array_sort(F.collect_list(F.struct("from_word", "words"))).alias("__mix_ranges"), F.sum("words").alias("__mix_taken")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, text_col):
                texts, sizes, counts, ranges = (batch.column(batch.schema.get_field_index(c)) for c in (text_col, "__mix_size", "__mix_taken", "__mix_ranges"))
                out = [t.as_py() if n == m else _cut_words(t.as_py(), [(r["from_word"], r["words"]) for r in some.as_py()])
                       for t, n, m, some in zip(texts, sizes.to_pylist(), counts.to_pylist(), ranges)]
                columns = [pa.array(out, pa.string()) if f.name == text_col else batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    joined = kept.join(taken.hint("merge"), "__mix_row").withColumn(text_col, F.col(text_col).cast("string")).drop("__mix_row", "pass")
    return joined.mapInArrow(cut, ", ".join(f"`{f.name}` {'string' if f.name == text_col else f.dataType.simpleString()}" for f in schema.fields))
