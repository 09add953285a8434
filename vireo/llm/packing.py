"""Operator 4: best-two-fit packing into fixed-length sequences.

Documents become token ids; only those longer than a sequence are cut.  What
is packed is then a bag of piece lengths between 1 and the capacity, so the
whole corpus is described by one count per length.  The plan is made on those
counts: a bin is filled greedily, longest piece first; while it has a gap, its
smallest piece is taken out again if two unpacked pieces fit the expanded gap
more tightly.  The same bin is repeated as often as the counts allow, so the
plan has a few thousand rows at any corpus size.

Pieces find their place by rank: every piece is numbered inside (task, length)
as it is made, the tasks' counts are summed per length by a window, and the
rank within its length is looked up in the plan, which is bounded by the
capacity and so can be shipped with the tasks.

Defined cases: null text is empty, and an empty text is one piece of one token
(the end id); repeated rows and repeated ids are packed as rows of their own;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import byte_slices, stored, worker_cache

CAPACITY = 1024
END_ID = 2
#: Encoded words of each of the two generations that a Python worker keeps.
CACHE_WORDS = 250_000
#: Bytes of text whose words are looked up together.
TEXT_BYTES = 1 << 16
#: New words that are encoded in one call.
WORDS_AT_ONCE = 256
_RANK_BITS = 44


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids (little-endian uint32 bytes) of whole texts, with a cache of encoded words in two generations.

    The tokenizer's pre-tokenisation always starts a new piece at a single space or
    line end that a visible character follows, and between a letter and a closing
    comma or stop, so such parts can be encoded apart and joined.  Texts where that
    doesn't hold (runs of white space, special-token marks) are encoded in one go.

    Words that are used go to the young generation; when it is full it becomes the old one, whose words
    move on as they are used again and go when the next one is full.
    """

    def __init__(self, path: str):
        # tasks are the parallelism; the library's own threads would only wait on each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        # byte-level vocabularies write a leading space as U+0120 and a line end as U+010A
        self.opens_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.opens_word[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(("\u0120", "\u010a"))]] = True
        self.closing = {c: self._whole(c) for c in ",."}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many to a text: each starts with a space or line end, which only first tokens can hold."""
        cache, plain, closed = self.cache, [], []
        for w in words:
            first = w[1:2] if w[:1] == "\n" else w[:1]
            if not first or not (first.isalnum() or "!" <= first <= "~"):
                cache[w] = None  # its text is encoded in one go
            elif w[-1] in ",." and w[-2:-1].isalpha():
                closed.append(w)
            else:
                plain.append(w)
        plain += sorted({w[:-1] for w in closed}.difference(cache, plain))
        for i in range(0, len(plain), WORDS_AT_ONCE * 64):
            groups = [plain[j:j + WORDS_AT_ONCE] for j in range(i, min(i + WORDS_AT_ONCE * 64, len(plain)), WORDS_AT_ONCE)]
            joined = self.tokenizer.encode_batch_fast(["".join([w if w[0] == "\n" else " " + w for w in g]) for g in groups], add_special_tokens=False)
            for group, e in zip(groups, joined):
                ids = np.array(e.ids, dtype="<u4")
                at = np.flatnonzero(self.opens_word[ids]) * 4
                data, at = ids.tobytes(), at.tolist()
                same = len(at) == len(group)  # expected; else the words go through whole texts
                cache.update(zip(group, [data[a:b] for a, b in zip(at, [*at[1:], len(data)])] if same else [None] * len(group)))
        for w in closed:
            base = cache[w[:-1]]
            cache[w] = None if base is None else base + self.closing[w[-1]]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of every text; new words of all texts are learned together."""
        if len(self.cache) > CACHE_WORDS:
            self.old, self.cache = self.cache, {}
        parts = [t.replace("\n", " \n").split(" ") if t and "<|" not in t else [] for t in texts]
        cache, old = self.cache, self.old
        missing = set().union(*[p[1:] for p in parts]).difference(cache)
        again = [w for w in missing if w in old]
        cache.update([(w, old[w]) for w in again])
        if len(again) < len(missing):
            self._learn(list(missing.difference(again)))
        word, out = cache.__getitem__, []
        for text, part in zip(texts, parts):
            found = [*map(word, part[1:])] if len(part) > 1 and part[0] else None
            if found is None or None in found:
                out.append(self._whole(text) if text else b"")
            else:
                out.append(self._whole(part[0]) + b"".join(found))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first may be shorter than the capacity."""
    if tokens <= capacity:
        return [(0, tokens)]
    head = tokens % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, tokens, capacity)]


def plan_bins(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as ([(length, uses) by falling length], repetitions); ``counts[l]`` pieces have length l."""
    left = np.array(counts, dtype=np.int64)
    bins = []
    while (present := np.flatnonzero(left)).size:
        used: dict[int, int] = {}
        gap = capacity
        for length in present[::-1].tolist():
            n = min(gap // length, int(left[length]))
            if n:
                used[length] = n
                gap -= n * length
            if not gap:
                break
        while gap:
            smallest = min(used)
            if sum(used.values()) == 1:
                break  # the bin's only piece is the longest one left
            free = left.copy()
            for length, n in used.items():
                free[length] -= n
            some, two = free > 0, free > 1
            pair = None
            for total in range(smallest + gap, smallest, -1):
                lows = np.arange(1, total // 2 + 1)
                fits = some[lows] & some[total - lows]
                if total % 2 == 0:
                    fits[-1] = two[total // 2]
                if fits.any():
                    low = int(lows[fits][-1])
                    pair = (low, total - low)
                    break
            if pair is None:
                break
            used[smallest] -= 1
            if not used[smallest]:
                del used[smallest]
            for x in pair:
                used[x] = used.get(x, 0) + 1
            gap -= sum(pair) - smallest
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
        bins.append((sorted(used.items(), reverse=True), times))
    return bins


def plan_lookup(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """The plan by (length, rank): rows sorted by ``length << 44 | first rank``."""
    rows, next_rank, sequence = [], {}, 0
    for used, times in plan_bins(counts, capacity):
        offset = 0
        for length, n in used:
            rank = next_rank.get(length, 0)
            rows.append((length << _RANK_BITS | rank, n, sequence, offset))
            next_rank[length] = rank + n * times
            offset += n * length
        sequence += times
    out = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"key": out[:, 0], "uses": out[:, 1], "sequence": out[:, 2], "offset": out[:, 3]}


_PIECE = "piece int, start long, length long, ids_crc32 long, part int, nth long"


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of one length inside a task (``part``)."""
    path = tokenizer or default_tokenizer()
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = worker_cache().get(path)
        if encoder is None:
            encoder = worker_cache()[path] = Encoder(path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = struct.pack("<I", END_ID)
        for batch in (part for whole in batches for part in byte_slices(whole, "text", TEXT_BYTES)):
            rows, took, ids = [], [], []
            for i, data in enumerate(encoder.encode_many([t or "" for t in batch.column(1).to_pylist()])):
                data += end
                for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    body = data[4 * start:4 * (start + length)]
                    rows.append((k, start, length, zlib.crc32(body), part, int(seen[length])))
                    seen[length] += 1
                    took.append(i)
                    if with_ids:
                        ids.append(body)
            table = np.array(rows, dtype=np.int64).reshape(-1, 6).T
            arrays = [batch.column(0).take(pa.array(took, pa.int64())), pa.array(table[0], pa.int32()), *[pa.array(c) for c in table[1:4]], pa.array(table[4], pa.int32()), pa.array(table[5])]
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(pieces, f"id {id_type}, {_PIECE}{', ids binary' * with_ids}")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and its ``offset`` there (``ids`` too, on request)."""
    made = stored(token_pieces(docs, id_col, text_col, capacity, tokenizer, with_ids), "pieces")
    by_task = stored(made.groupBy("length", "part").count(), "piece-counts")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most one row per length
        counts[r["length"]] = r["n"]
    plan = plan_lookup(counts, capacity)
    before = by_task.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = made.join(before.select("length", "part", F.coalesce("before", F.lit(0)).alias("before")), ["length", "part"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = (length << _RANK_BITS) | batch.column("rank").to_numpy()
            row = np.searchsorted(plan["key"], key, "right") - 1
            nth, uses = key - plan["key"][row], plan["uses"][row]
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(plan["sequence"][row] + nth // uses), pa.array(plan["offset"][row] + nth % uses * length)], [*keep, "sequence_id", "offset"])

    columns = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = ranked.select(*columns, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")
