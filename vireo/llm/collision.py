"""Operator 9: near-duplicate embeddings by collision counting over sorted projections.

``m`` orders sort the vectors' directions by one Gaussian projection each, inside the cells that the
signs of ``g`` further projections cut out (one more sign halves the far pairs that meet, so g grows
with the logarithm of the number of vectors).  In each order a window of half-width ``w`` is centred
on every vector; a pair collides in an order if both stand in one cell and one window.  Pairs with
at least ``least_count`` collisions are verified by cosine in double precision.

Calibration: at the threshold cosine c a sign agrees with probability 1 - acos(c)/pi, and projections
differ by a normal variable of variance 2 - 2c, so the collision probability p of a pair at the
threshold is known; m is the smallest number for which a binomial(m, p) count reaches
``least_count`` with probability ``recall``.  Closer pairs do better.

Equal vectors collapse to their smallest id before the search.  A cell that holds many different
vectors is cut into blocks, and pairs of blocks go to tasks of their own, so no task grows with a
dense cell.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing
and stand alone; of rows that repeat an id the smallest usable vector stands; a null id gives a row
with null component that is kept; vectors of different dimension don't link; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import mix64, stored
from vireo.llm.graph import components
from vireo.llm.vectors import by_dimension, one_per_id

COSINE = 0.95
RECALL = 0.995
LEAST_COUNT = 2
WINDOW = 0.5
#: Vectors aimed at per cell, and the size from which a cell is cut into blocks.
CELL_ROWS, BLOCK_ROWS = 16, 2048
SEED = 5


def calibrate(n: int, cosine: float = COSINE, recall: float = RECALL, least_count: int = LEAST_COUNT) -> tuple[int, int]:
    """(signs per order, number of orders) for ``n`` vectors."""
    signs = max(0, math.ceil(math.log2(max(n, 1) / CELL_ROWS))) if n > CELL_ROWS else 0
    agree = (1 - math.acos(cosine) / math.pi) ** signs
    p = agree * math.erf(WINDOW / math.sqrt(2 - 2 * cosine) / math.sqrt(2))
    m = least_count
    while sum(math.comb(m, i) * p ** i * (1 - p) ** (m - i) for i in range(least_count)) > 1 - recall:
        m += 1
    return signs, m


def gaussians(order: int, count: int, dimension: int, seed: int = SEED) -> np.ndarray:
    """The projections of one order (its signs, then its value) for one dimension."""
    return np.random.Generator(np.random.Philox([seed, order << 32 | dimension])).standard_normal((dimension, count))


def _positions(orders: int, signs: int):
    """Task function: every vector's cell and value in every order."""

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for rows, x in by_dimension(batch.column("v")):
                d = x.shape[1]
                if d not in made:
                    made[d] = np.concatenate([gaussians(o, signs + 1, d) for o in range(orders)], axis=1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for lo in range(0, len(rows), 4096):
                    part = (x[lo:lo + 4096] @ made[d]).reshape(-1, orders, signs + 1)
                    cell = np.zeros(part.shape[:2], dtype=np.uint64)
                    for s in range(signs):
                        cell = cell << np.uint64(1) | (part[:, :, s] > 0).astype(np.uint64)
                        if s % 48 == 47:
                            cell = mix64(cell)
                    cell = mix64(cell + mix64(np.arange(orders, dtype=np.uint64) << np.uint64(32) | np.uint64(d))[None, :])
                    n = part.shape[0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[rows[lo:lo + n]], orders)), pa.array(cell.ravel().view(np.int64)), pa.array(part[:, :, signs].ravel())], ["id", "cell", "value"])

    return positions


def window_pairs(value: np.ndarray, side: np.ndarray, crossing: bool, width: float = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted ``value`` at most ``width`` apart; with ``crossing`` only between sides."""
    ends = np.searchsorted(value, value + width, "right")
    reach = ends - np.arange(len(value)) - 1
    at = 0
    while at < len(value):
        total = np.cumsum(reach[at:])
        to = at + max(1, int(np.searchsorted(total, 1 << 20, "right")))
        i = np.repeat(np.arange(at, min(to, len(value))), reach[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(reach[at:to]) - reach[at:to], reach[at:to])
        if crossing:
            across = side[i] != side[j]
            i, j = i[across], j[across]
        if len(i):
            yield i, j
        at = to


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each (cell, s, t) run of sorted rows."""
    key, ids, values, sides = None, [], [], []

    def pairs():
        one, value, side = np.concatenate(ids), np.concatenate(values), np.concatenate(sides)
        for i, j in window_pairs(value, side, key[1] != key[2]):
            a, b = one[i], one[j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    for batch in batches:
        cell, s, t = (batch.column(c).to_numpy() for c in ("cell", "s", "t"))
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (s[1:] != s[:-1]) | (t[1:] != t[:-1])) + 1
        one, value, side = (batch.column(c).to_numpy() for c in ("id", "value", "side"))
        for lo, hi in zip([0, *change], [*change, len(cell)]):
            now = (cell[lo], s[lo], t[lo])
            if now != key:
                if key is not None and sum(map(len, ids)) > 1:
                    yield from pairs()
                key, ids, values, sides = now, [], [], []
            ids.append(one[lo:hi])
            values.append(value[lo:hi])
            sides.append(side[lo:hi])
    if key is not None and sum(map(len, ids)) > 1:
        yield from pairs()


def colliding_pairs(distinct: DataFrame, signs: int, orders: int, least_count: int = LEAST_COUNT) -> DataFrame:
    """(a, b) with at least ``least_count`` collisions; a < b are ids of different vectors."""
    placed = stored(distinct.select("id", "v").mapInArrow(_positions(orders, signs), "id long, cell long, value double"), "projections")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    dense = cells.where(F.col("n") > BLOCK_ROWS)
    many = stored(dense, "dense-cells")
    sparse = placed.join(cells.where(F.col("n") <= BLOCK_ROWS).select("cell"), "cell").select("cell", F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(0).alias("side"), "id", "value")
    # pairs of blocks: block x goes to the tiles (min(x, y), max(x, y)) for every y
    blocked = placed.join(many, "cell").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tiles = blocked.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", F.least("side", "y").cast("int").alias("s"), F.greatest("side", "y").cast("int").alias("t"), "side", "id", "value")
    dealt = sparse.union(tiles).repartition("cell", "s", "t").sortWithinPartitions("cell", "s", "t", "value", "id")
    return (dealt.mapInArrow(_collisions, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count).select("a", "b"))


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cosine = np.zeros(batch.num_rows)
        for (rows, x), (_, y) in zip(by_dimension(batch.column("va")), by_dimension(batch.column("vb"))):
            x, y = (z / np.abs(z).max(axis=1, keepdims=True) for z in (x, y))
            cosine[rows] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(cosine)], ["a", "b", "cosine"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest: list = [None] * batch.num_rows
        for rows, x in by_dimension(batch.column("v")):
            x = x + 0.0  # minus zero equals zero
            for i, r in enumerate(rows):
                digest[r] = hashlib.blake2b(x[i].tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(digest, pa.binary())], ["id", "v", "digest"])


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                           recall: float = RECALL, least_count: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """(links between class representatives: a, b, cosine; membership: id, rep, copies)."""
    one = one_per_id(vectors, id_col, vector_col)
    kept = stored(one.mapInArrow(_digests, f"id long, v {one.schema['v'].dataType.simpleString()}, digest binary"), "vectors")
    classes = stored(kept.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    members = kept.select("id", "digest").join(classes, "digest").select("id", "rep", "copies")
    distinct = stored(kept.join(classes.select(F.col("rep").alias("id"), "digest"), ["id", "digest"]).select("id", "v"), "distinct-vectors")
    signs, orders = calibrate(distinct.count(), cosine, recall, least_count)
    pairs = colliding_pairs(distinct, signs, orders, least_count)
    both = (pairs.join(distinct.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")
            .join(distinct.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").where(F.size("va") == F.size("vb")))
    links = stored(both.select("a", "b", "va", "vb").mapInArrow(_cosines, "a long, b long, cosine double").where(F.col("cosine") >= cosine), "vector-links")
    return links, members


def vector_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    links, members = near_duplicate_vectors(vectors, id_col, vector_col, cosine)
    members = stored(members, "vector-members")
    copies = members.where("id = rep").select("rep", "copies")
    ends = links.select("a", "b").union(links.select("b", "a"))
    linked = ends.join(copies.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = components(links.select("a", "b"))
    classes = (copies.join(linked, F.col("rep") == F.col("a"), "left").join(found, F.col("rep") == F.col("node"), "left")
               .select("rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    placed = members.select("id", "rep").join(classes, "rep").select("id", "n_links", "component_id")
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    return (every.join(placed, F.col("vec_id") == F.col("id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
