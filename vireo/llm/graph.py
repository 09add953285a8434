"""Connected components of a link table: contraction inside tasks, then alternating stars on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import stored

#: Links that one task contracts at once (16 bytes each).
TASK_LINKS = 1_000_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable over the links) for all nodes of the links (u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # hook the roots of both ends to the smaller label, then jump to the roots
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as stars around the smallest nodes they connect."""
    u, v = [], []

    def stars():
        node, low = smallest_reachable(np.concatenate(u), np.concatenate(v))
        some = node != low
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(low[some])], ["u", "v"])

    held = 0
    for batch in batches:
        u.append(batch.column("u").to_numpy())
        v.append(batch.column("v").to_numpy())
        held += batch.num_rows
        if held >= 4 * TASK_LINKS:  # more than dealt: what is held is contracted first, so memory stays bounded
            star = stars()
            u, v = [star.column("u").to_numpy()], [star.column("v").to_numpy()]
            held = len(star)
    if u:
        yield stars()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is the smallest reachable node.

    Links are dealt to tasks of about ``TASK_LINKS`` and each task replaces its links by stars.  One task's stars
    are the components.  Several tasks' stars go on by alternating stars: each round points every node's
    larger neighbours at its smallest one, then every node's smaller neighbours at the smallest; it ends when
    the links are stars around the smallest nodes.  Minima are pre-aggregated in the map tasks and joined
    back, so a hot node is an ordinary skewed join.  Every round is written to the shared folder; only a
    count and a checksum reach the driver.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    tasks = max(1, -(-edges.count() // TASK_LINKS))
    edges = stored(edges.repartition(tasks, F.xxhash64("u", "v")).mapInArrow(_contract, "u long, v long").distinct(), "links")
    seen = _checksum(edges)
    while tasks > 1 and seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v"))).distinct()
