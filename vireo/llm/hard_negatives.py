"""Operator 12: hard negatives by segment summary filtering.

Components become whole numbers, floor(``SCALE`` * x), and a score is the integer
inner product.  A vector is cut into segments, and the mean and the deviation of
every finest segment are stored beside it (scaled by the segment's length: the
mean's share of the norm and the norm of what is left).  In a segment the product
of two vectors lies within their means' product plus or minus their deviations'
product, so sums over segments bound the score of a pair.  A tile of anchors and
rows is filtered by whole vectors first, then by 4, 16, ... segments (the coarse
summaries follow from the finest); each step sees only what the one before has
left, and only what passes the finest is scored exactly.  A level that removes
next to nothing in its tiles is tried in every ``PROBE``-th tile only.

The first sweep looks for each anchor's positives inside label runs: a pair goes on if its upper bound
reaches the k-th largest lower bound of its anchor in the tile and the k-th best
score so far.  The second looks for negatives: each positive sets a band of scores, a pair
goes on if its upper bound reaches the lowest bar of its anchor's lists and its
lower bound stays within the widest band.  The bounds are safe, so results are exact.

A task holds a block of anchors and goes through its share of the row blocks with
running lists; lists of an anchor's tasks meet in a window over at most
k rows a task.  Blocks are bounded and dealt by a hash of the id, whatever
labels or vectors are frequent.

Defined cases: rows with a null id or label, and vectors that are null, empty or hold null or non-finite
components take no part (zero vectors do); of rows that repeat an id the smallest
(vector, label) stands; vectors of different dimension aren't compared; codes are
held within 32 bits, and scores are exact where they fit a long; equal scores go by the smaller id; an anchor without
other rows of its label has no positives and so no rows; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import stored

SCALE, LARGEST = 256.0, (1 << 31) - 1
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
BAND = (30, 90)
ANCHOR_MODULUS = 100
#: Rows of a base block and of an anchor block; anchors and rows of one tile.
BASE_ROWS, ANCHOR_ROWS, TILE_ANCHORS, TILE_ROWS = 4096, 2048, 256, 2048
TASKS_PER_CORE = 2
#: A level that removes less than ``USELESS`` of its pairs is tried in each ``PROBE``-th tile.
USELESS, PROBE = 0.05, 16
_LEAST = np.iinfo(np.int64).min


# ---------------------------------------------------------------- summaries and bounds

def level_counts(dimension: int) -> list[int]:
    """Segments of each level, coarse to fine; finest segments have about four components or more."""
    out = [1]
    while out[-1] * 4 <= dimension / 4:
        out.append(out[-1] * 4)
    return out


def cuts(dimension: int, segments: int) -> np.ndarray:
    return np.arange(segments + 1) * dimension // segments


def summaries(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean times root of length, norm of the deviation) of every finest segment."""
    at = cuts(codes.shape[1], level_counts(codes.shape[1])[-1])
    length = np.diff(at)
    x = codes.astype(np.float64)
    mean = np.add.reduceat(x, at[:-1], axis=1) / length
    rest = x - np.repeat(mean, length, axis=1)
    return mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, at[:-1], axis=1))


def coarser(mean: np.ndarray, deviation: np.ndarray, dimension: int, segments: int, fewer: int) -> tuple[np.ndarray, np.ndarray]:
    """The summaries of ``fewer`` segments from those of ``segments``."""
    length = np.diff(cuts(dimension, segments))
    start = np.arange(fewer) * (segments // fewer)
    total = np.diff(cuts(dimension, fewer))
    middle = np.add.reduceat(mean * np.sqrt(length), start, axis=1) / total
    spread = mean - np.repeat(middle, segments // fewer, axis=1) * np.sqrt(length)
    return middle * np.sqrt(total), np.sqrt(np.add.reduceat(deviation ** 2 + spread ** 2, start, axis=1))


class Block:
    """Rows of one dimension, sorted by label: ids, labels, codes, and summaries of every level."""

    def __init__(self, ids: bytes, labels: bytes, codes: bytes, means: bytes, deviations: bytes, dimension: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.codes = np.frombuffer(codes, np.int32).reshape(-1, dimension)
        counts = level_counts(dimension)
        finest = [np.frombuffer(x, np.float64).reshape(-1, counts[-1]) for x in (means, deviations)]
        self.levels = [coarser(*finest, dimension, counts[-1], c) for c in counts[:-1]] + [tuple(finest)]
        self.norm = np.sqrt((self.codes.astype(np.float64) ** 2).sum(axis=1))
        self.largest = int(np.abs(self.codes).max(initial=0))

    def runs(self) -> dict[int, tuple[int, int]]:
        at = np.flatnonzero(np.concatenate(([True], self.labels[1:] != self.labels[:-1])))
        return {int(self.labels[lo]): (int(lo), int(hi)) for lo, hi in zip(at, [*at[1:], len(self.ids)])}


def exact_scores(q: Block, rows: np.ndarray, b: Block, cols: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (rows, cols)."""
    out = np.empty(len(rows), np.int64)
    for lo in range(0, len(rows), 1 << 15):
        x, y = q.codes[rows[lo:lo + (1 << 15)]], b.codes[cols[lo:lo + (1 << 15)]]
        out[lo:lo + (1 << 15)] = np.einsum("ij,ij->i", x.astype(np.int64), y.astype(np.int64))
    return out


class Filter:
    """Pairs of a tile that pass the bounds of all levels, with what each level has removed so far."""

    def __init__(self, levels: int):
        self.seen, self.removed, self.tiles = np.zeros(levels), np.zeros(levels), 0

    def passing(self, q: Block, rows: np.ndarray, b: Block, cols: np.ndarray, open_: np.ndarray, need: np.ndarray, limit: np.ndarray | None, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Positions (i, j) in ``rows`` x ``cols`` of the open pairs that may score between ``need`` and ``limit``.

        With ``k`` a pair must also reach the k-th largest lower bound of its row.
        """
        self.tiles += 1
        column = np.arange(len(cols))
        need = need.astype(np.float64)
        for level, (mean, deviation) in enumerate(q.levels):
            if not open_.any():
                break
            if self.seen[level] > 1e6 and self.removed[level] < USELESS * self.seen[level] and self.tiles % PROBE:
                continue
            take = cols[column]
            near = mean[rows] @ b.levels[level][0][take].T
            slack = deviation[rows] @ b.levels[level][1][take].T
            slack += 1e-9 * (np.outer(q.norm[rows], b.norm[take]) + 1)
            before = np.count_nonzero(open_)
            if k and len(column) > k:
                least = np.where(open_, near - slack, -np.inf)
                need = np.maximum(need, np.partition(least, -k, axis=1)[:, -k])
            open_ = open_ & (near + slack >= need[:, None])
            if limit is not None:
                open_ &= near - slack <= limit[:, None]
            self.seen[level] += before
            self.removed[level] += before - np.count_nonzero(open_)
            some = open_.any(axis=0)
            if some.mean() < 0.7:
                column, open_ = column[some], open_[:, some]
        i, j = np.nonzero(open_)
        return i, column[j]


def scored(q: Block, rows: np.ndarray, b: Block, cols: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs; where many of a tile are left, by one product that holds whole numbers exactly."""
    bound = q.largest * b.largest * q.codes.shape[1]
    if len(i) * 20 > len(rows) * len(cols) and bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        return (q.codes[rows].astype(kind) @ b.codes[cols].astype(kind).T)[i, j].astype(np.int64)
    return exact_scores(q, rows[i], b, cols[j])


class Lists:
    """The k best (id, score) of every row: larger scores first, ties by smaller id."""

    def __init__(self, rows: int, k: int, floor: np.ndarray | None = None):
        self.k, self.n = k, rows
        self.row, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(rows, _LEAST) if floor is None else floor.copy()

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        some = score >= self.floor[row]
        if not some.any():
            return
        row, ids, score = (np.concatenate(x) for x in ((self.row, row[some]), (self.id, ids[some]), (self.score, score[some])))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        per = np.bincount(row, minlength=self.n)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        top = rank < self.k
        self.row, self.id, self.score = row[top], ids[top], score[top]
        last = rank[top] == self.k - 1
        self.floor[self.row[last]] = self.score[last]


# ---------------------------------------------------------------- the two searches

class Positives:
    """The best rows of the anchors' own labels."""

    schema = "anchor long, id long, score long"

    def __init__(self, block: Block, extra: list, k: int, band: tuple[int, int]):
        self.q, self.runs, self.best, self.filter = block, block.runs(), Lists(len(block.ids), k), Filter(len(block.levels))

    def meet(self, b: Block) -> None:
        for label, (lo, hi) in b.runs().items():
            if label not in self.runs:
                continue
            first, last = self.runs[label]
            for r in range(first, last, TILE_ANCHORS):
                rows = np.arange(r, min(r + TILE_ANCHORS, last))
                for c in range(lo, hi, TILE_ROWS):
                    cols = np.arange(c, min(c + TILE_ROWS, hi))
                    others = self.q.ids[rows][:, None] != b.ids[cols][None, :]
                    i, j = self.filter.passing(self.q, rows, b, cols, others, self.best.floor[rows], None, self.best.k)
                    if len(i):
                        self.best.add(rows[i], b.ids[cols[j]], scored(self.q, rows, b, cols, i, j))

    def results(self) -> list[np.ndarray]:
        return [self.q.ids[self.best.row], self.best.id, self.best.score]


class Negatives:
    """For each anchor and positive, the best rows of other labels inside the positive's band."""

    schema = "anchor long, positive long, positive_score long, id long, score long"

    def __init__(self, block: Block, extra: list, k: int, band: tuple[int, int]):
        self.q, self.filter = block, Filter(len(block.levels))
        n, width = len(block.ids), max([len(x) for x in extra], default=0)
        self.width = width
        self.positive, self.of, self.low, self.high = (np.full((n, width), v, np.int64) for v in (0, 0, 1, 0))
        for i, found in enumerate(extra):
            for p, x in enumerate(found):
                s = x["score"]
                self.positive[i, p], self.of[i, p] = x["id"], s
                # whole scores t with band[0] * s <= 100 * t <= band[1] * s
                self.low[i, p], self.high[i, p] = -(-band[0] * s // 100), band[1] * s // 100
        self.some = self.low <= self.high
        self.best = Lists(n * width, k, np.where(self.some, self.low, np.iinfo(np.int64).max).ravel())
        self.limit = np.where(self.some, self.high, _LEAST).max(axis=1, initial=_LEAST)

    def meet(self, b: Block) -> None:
        for r in range(0, len(self.q.ids), TILE_ANCHORS):
            rows = np.arange(r, min(r + TILE_ANCHORS, len(self.q.ids)))
            rows = rows[self.some[rows].any(axis=1)]
            for c in range(0, len(b.ids) if len(rows) else 0, TILE_ROWS):
                cols = np.arange(c, min(c + TILE_ROWS, len(b.ids)))
                other = self.q.labels[rows][:, None] != b.labels[cols][None, :]
                floor = self.best.floor.reshape(-1, self.width)[rows]
                i, j = self.filter.passing(self.q, rows, b, cols, other, floor.min(axis=1), self.limit[rows].astype(np.float64))
                if not len(i):
                    continue
                score, row, ids = scored(self.q, rows, b, cols, i, j), rows[i], b.ids[cols[j]]
                for p in range(self.width):
                    fits = self.some[row, p] & (score >= self.low[row, p]) & (score <= self.high[row, p])
                    self.best.add(row[fits] * self.width + p, ids[fits], score[fits])

    def results(self) -> list[np.ndarray]:
        row, p = self.best.row // max(self.width, 1), self.best.row % max(self.width, 1)
        return [self.q.ids[row], self.positive[row, p], self.of[row, p], self.best.id, self.best.score]


# ---------------------------------------------------------------- blocks and sweeps

def taking_part(vector_col: str) -> Column:
    """Not null, not empty, all components finite."""
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite, F.lit(False))


_BLOCK = "g int, dimension int, ids binary, labels binary, codes binary, means binary, deviations binary, positives array<array<struct<score:long,id:long>>>"


def _blocks(rows: DataFrame, groups: int, limit: int) -> DataFrame:
    """``rows`` (id, label, v, positives) as blocks of at most ``limit`` rows of one dimension, sorted by label, with their summaries."""
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"), F.size("v").alias("d"), "label", "id", "v", "positives")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, key[1])
            codes = np.clip(np.floor(SCALE * x), -LARGEST, LARGEST).astype(np.int32)
            mean, deviation = summaries(codes)
            arrays = [pa.array([v], t) for v, t in zip(key, (pa.int32(), pa.int32()))]
            arrays += [pa.array([v.tobytes()], pa.binary()) for v in (table.column("id").to_numpy(), table.column("label").to_numpy(), codes, mean, deviation)]
            positives = pa.array([table.column("positives").to_pylist()], pa.list_(pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64())]))))
            return pa.RecordBatch.from_arrays([*arrays, positives], ["g", "dimension", "ids", "labels", "codes", "means", "deviations", "positives"])

        for batch in batches:
            g, d = batch.column("g").to_numpy(), batch.column("d").to_numpy()
            change = np.flatnonzero((g[1:] != g[:-1]) | (d[1:] != d[:-1])) + 1
            for lo, hi in zip([0, *change], [*change, len(g)]):
                if hi > lo and key != (int(g[lo]), int(d[lo])):
                    if held:
                        yield block()
                    key, held = (int(g[lo]), int(d[lo])), []
                while lo < hi:
                    to = min(hi, lo + limit - sum(x.num_rows for x in held))
                    held.append(batch.slice(lo, to - lo))
                    if sum(x.num_rows for x in held) == limit:
                        yield block()
                        held = []
                    lo = to
        if held:
            yield block()

    return dealt.repartition(groups, "g").sortWithinPartitions("g", "d", "label", "id").mapInArrow(pack, _BLOCK)


def _sweep(base: DataFrame, base_groups: int, anchors: DataFrame, anchor_groups: int, search: type, k: int, band: tuple[int, int]) -> DataFrame:
    """What ``search`` finds for blocks of ``anchors`` in the stored blocks ``base``: rows of its schema, at most k for each list and task."""
    cores = base.sparkSession.sparkContext.defaultParallelism
    shares = max(1, min(base_groups, -(-TASKS_PER_CORE * cores // anchor_groups)))
    columns = ["g", "dimension", "ids", "labels", "codes", "means", "deviations", "positives"]
    held = base.select(F.explode(F.sequence(F.lit(0), F.lit(anchor_groups - 1))).alias("h"), (F.col("g") % shares).alias("r"), F.lit(1).alias("kind"), *columns)
    asked = anchors.select(F.col("g").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("r"), F.lit(0).alias("kind"), *columns)
    dealt = held.union(asked).repartition(anchor_groups * shares, "h", "r").sortWithinPartitions("h", "r", "dimension", "kind", "g")
    names = [c.split()[0] for c in search.schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, searches = None, []

        def results():
            for s in searches:
                out = s.results()
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

        for batch in batches:
            for i in range(batch.num_rows):
                h, r, d, kind = (batch.column(c)[i].as_py() for c in ("h", "r", "dimension", "kind"))
                if key != (h, r, d):
                    yield from results()
                    key, searches = (h, r, d), []
                if kind == 1 and not searches:
                    continue
                block = Block(*[batch.column(c)[i].as_py() for c in columns[2:7]], d)
                if kind == 0:
                    searches.append(search(block, [x or [] for x in batch.column("positives")[i].as_py()], k, band))
                else:
                    for s in searches:
                        s.meet(block)
        yield from results()

    return dealt.mapInArrow(run, search.schema)


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of each group, at most k rows of each task in it, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", modulus: int = ANCHOR_MODULUS,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
                   base_rows: int = BASE_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every row whose id ``modulus`` divides."""
    part = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & taking_part(vector_col))
    part = part.select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(vector_col).alias("v"), F.col(label_col).cast("long").alias("label")).alias("x"))
    none = F.lit(None).cast("array<struct<score:long,id:long>>").alias("positives")
    rows = stored(part.groupBy("id").agg(F.min("x").alias("x")).select("id", "x.label", "x.v", none), "labelled-vectors")
    anchors = rows.where(F.col("id") % modulus == 0)
    base_groups, anchor_groups = max(1, -(-rows.count() // base_rows)), max(1, -(-anchors.count() // anchor_rows))
    base = stored(_blocks(rows, base_groups, base_rows), "vector-blocks")
    near = _first(_sweep(base, base_groups, _blocks(anchors, anchor_groups, anchor_rows), anchor_groups, Positives, positives, band), ["anchor"], positives)
    # at most ``positives`` rows an anchor
    lists = near.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(F.struct("score", F.col("id").alias("id")))).alias("positives"))
    asked = stored(_blocks(anchors.drop("positives").join(lists, "id"), anchor_groups, anchor_rows), "anchor-blocks")
    found = _first(_sweep(base, base_groups, asked, anchor_groups, Negatives, negatives, band), ["anchor", "positive"], negatives)
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """The contract's labels: where 7 divides the id, the next of ten."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
