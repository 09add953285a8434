"""Operator 1: nearest neighbours by a block matrix join.

Vectors are packed into blocks of one dimension.  Each component is rounded to an
int8 code with a scale per vector, and the norms of the code and of the rounding
error are kept.  Query blocks meet base blocks in tiles: one matrix product of
codes gives all inner products of a tile, and Cauchy-Schwarz bounds how far
rounding can move each of them: |x.y - x'.y'| <= |x'||y - y'| + |x - x'||y|.
A pair survives if its upper bound reaches the k-th largest lower bound that its
query has in the tile, or the k-th best score that the query already has; only
survivors are computed from the original vectors in double precision.  The
bounds are safe, so the result is exact.

A task holds one query block and goes through its share of the base blocks with
a running list per query; the lists of a query's tasks are merged by a heap.
Tasks get bounded blocks, whatever vectors or ids are frequent.

Defined cases: vectors that are null, zero, or hold null or non-finite components
take no part; rows with a null id are left out; of rows that repeat an id the
smallest vector stands; vectors of different dimension aren't compared; ties in
score go to the smaller id; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import stored
from vireo.llm.vectors import one_per_id

NEIGHBOURS = 20
QUERY_MODULUS = 20
#: Vectors of a base block, of a query block, and queries of one product.
BASE_ROWS, QUERY_ROWS, PRODUCT_ROWS = 8192, 8192, 256
#: Tasks aimed at for each core; a query block's base blocks are shared among as many as this needs.
TASKS_PER_CORE = 2


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the coded vector, norm of the rounding error."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


class Block:
    """A packed block of vectors of one dimension: ids, vectors and codes with their bounds."""

    def __init__(self, ids: bytes, vectors: bytes, dimension: int):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.x = np.frombuffer(vectors, dtype=np.float64).reshape(-1, dimension)
        self.codes, self.scale, self.coded, self.error = quantise(self.x)
        self.norm = np.linalg.norm(self.x, axis=1)
        # products of codes are whole numbers; single precision holds them exactly up to 2^24
        self.exact = self.codes.astype(np.float32 if dimension * 127 * 127 < 1 << 24 else np.float64)


def tile_best(q: Block, base: Block, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, base id, score) of the pairs that can be among the k nearest; ``floor``: k-th best so far."""
    rows, ids, scores = [], [], []
    for lo in range(0, len(q.ids), PRODUCT_ROWS):
        hi = min(lo + PRODUCT_ROWS, len(q.ids))
        near = (q.exact[lo:hi] @ base.exact.T).astype(np.float64)
        near *= q.scale[lo:hi, None]
        near *= base.scale[None, :]
        slack = np.outer(q.coded[lo:hi], base.error) + np.outer(q.error[lo:hi], base.norm)
        slack += 1e-12 * np.outer(q.norm[lo:hi], base.norm)
        own = q.ids[lo:hi, None] == base.ids[None, :]
        near[own] = -np.inf
        least = near - slack
        if base.ids.size > k:
            bar = np.maximum(np.partition(least, -k, axis=1)[:, -k], floor[lo:hi])
        else:
            bar = floor[lo:hi]
        near += slack
        i, j = np.nonzero((near >= bar[:, None]) & ~own)
        for a in range(0, len(i), 1 << 16):
            ii, jj = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
            rows.append(ii + lo)
            ids.append(base.ids[jj])
            scores.append((q.x[ii + lo] * base.x[jj]).sum(axis=1))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)


class Best:
    """The k best (id, score) of every query of a block."""

    def __init__(self, queries: int, k: int):
        self.k, self.n = k, queries
        self.row, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.floor = np.full(queries, -np.inf)

    def add(self, row: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        row, vec, score = (np.concatenate(x) for x in ((self.row, row), (self.id, vec), (self.score, score)))
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        per = np.bincount(row, minlength=self.n)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
        top = rank < self.k
        self.row, self.id, self.score = row[top], vec[top], score[top]
        last = rank[top] == self.k - 1
        self.floor[self.row[last]] = self.score[last]


def _packed(vectors: DataFrame, groups: int, rows: int) -> DataFrame:
    """Blocks (g, dimension, ids, vectors) of at most ``rows`` vectors; ids are dealt to ``groups`` by hash."""
    dealt = vectors.select("id", F.size("v").alias("d"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"), "v")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def block():
            ids = np.concatenate([x for x, _ in held])
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([ids.tobytes()]), pa.array([np.concatenate([x for _, x in held]).tobytes()])], ["g", "dimension", "ids", "vectors"])

        for batch in batches:
            g, d, ids = batch.column("g").to_numpy(), batch.column("d").to_numpy(), batch.column("id").to_numpy()
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(d)
            change = np.flatnonzero((g[1:] != g[:-1]) | (d[1:] != d[:-1])) + 1
            for lo, hi in zip([0, *change], [*change, len(g)]):
                if key != (g[lo], d[lo]):
                    if held:
                        yield block()
                    held, key = [], (g[lo], d[lo])
                while lo < hi:
                    room = rows - sum(len(x) for x, _ in held)
                    to = min(hi, lo + room)
                    held.append((ids[lo:to], flat[ends[lo] - d[lo]:ends[to - 1]]))
                    if to - lo == room:
                        yield block()
                        held = []
                    lo = to
        if held:
            yield block()

    return dealt.repartition("g").sortWithinPartitions("g", "d", "id").mapInArrow(pack, "g int, dimension int, ids binary, vectors binary")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS,
            modulus: int = QUERY_MODULUS, base_rows: int = BASE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of every vector whose id ``modulus`` divides."""
    spark = vectors.sparkSession
    kept = stored(one_per_id(vectors, id_col, vector_col), "vectors")
    n = kept.count()
    queries = kept.where(F.col("id") % modulus == 0)
    base_groups = max(1, -(-n // base_rows))
    query_groups = max(1, -(-queries.count() // query_rows))
    shares = max(1, min(base_groups, -(-TASKS_PER_CORE * spark.sparkContext.defaultParallelism // query_groups)))
    cells = query_groups * shares
    side = lambda kind: [F.lit(kind).alias("kind"), "g", "dimension", "ids", "vectors"]
    base = _packed(kept, base_groups, base_rows).select(F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))).alias("h"), (F.col("g") % shares).alias("r"), *side(1))
    asked = _packed(queries, query_groups, query_rows).select(F.col("g").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("r"), *side(0))
    dealt = base.union(asked).repartition(cells, "h", "r").sortWithinPartitions("h", "r", "dimension", "kind", "g")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def results():
            for q, best in held:
                if not len(best.row):
                    continue
                per = np.bincount(best.row, minlength=best.n)
                some = np.flatnonzero(per)
                offsets = pa.array(np.concatenate(([0], np.cumsum(per[some]))).astype(np.int32))
                found = pa.StructArray.from_arrays([pa.array(-best.score), pa.array(best.id)], ["minus", "id"])
                yield pa.RecordBatch.from_arrays([pa.array(q.ids[some]), pa.ListArray.from_arrays(offsets, found)], ["query_id", "found"])

        for batch in batches:
            for i in range(batch.num_rows):
                h, r, d, kind = (batch.column(c)[i].as_py() for c in ("h", "r", "dimension", "kind"))
                if key != (h, r, d):
                    yield from results()
                    key, held = (h, r, d), []
                if kind == 1 and not held:
                    continue
                block = Block(batch.column("ids")[i].as_py(), batch.column("vectors")[i].as_py(), d)
                if kind == 0:
                    held.append((block, Best(len(block.ids), k)))
                else:
                    for q, best in held:
                        best.add(*tile_best(q, block, k, best.floor))
        yield from results()

    lists = dealt.mapInArrow(search, "query_id long, found array<struct<minus:double,id:long>>").groupBy("query_id").agg(F.collect_list("found").alias("lists"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for query, found in zip(batch.column("query_id").to_pylist(), batch.column("lists").to_pylist()):
                merged = heapq.merge(*[[(x["minus"], x["id"]) for x in one] for one in found])
                out += [(query, rank, vec, -minus) for rank, (minus, vec) in zip(range(1, k + 1), merged)]
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.float64())], ["query_id", "rank", "vec_id", "score"])

    return lists.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
