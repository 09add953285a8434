"""Boosted trees on sparse vectors: the trees of ``GBTClassifier``, grown from the slots that rows fill.

Spark's tree learners hold a bin for every slot of every row and read all of them once a tree level; hashed texts fill
about one slot in seventeen.  Here a row holds only the slots whose bin is not the bin of zero, and the counts of that
bin are what the others leave of the node's totals.  Thresholds, losses, split choice, stopping and pruning are
those of ``GBTClassifier``, and so is the model; thresholds come from the values of all rows (``GBTClassifier`` takes them
from about 10,000 rows where there are more).

Rows lie in blocks: numpy arrays in a persisted RDD.  A tree level is one job: each task sums its rows' targets by
(node, slot, bin), the sums meet by ranges of slots, and only the best split of each range reaches the driver.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Filled slots up to which a fit's rows lie in one task (a level's job then costs more than its sums), and what a task
#: aims at beyond them.
ENTRIES_IN_ONE, ENTRIES_PER_TASK = 8_000_000, 2_000_000
#: Rows and filled slots that one block holds at most.
BLOCK_ROWS, BLOCK_ENTRIES = 16_384, 4_000_000
#: Bytes of sums that a task holds for the nodes it counts together.
SUMS_BYTES = 96 << 20
#: Rounds after which the rows' scores are computed from all trees again, so that plans stay short.
REBUILD_ROUNDS = 10
EPSILON = float(np.finfo(float).eps)
#: Gains that differ by less than this share of a node's mean square are the same.
TIE = 1e-12


class Bins(NamedTuple):
    """The slots with thresholds, in order.  Cells are (slot, bin) pairs, numbered through."""

    place: np.ndarray  # slot -> its position among those with thresholds, -1 without
    slots: np.ndarray  # position -> slot
    thresholds: list[np.ndarray]
    first: np.ndarray  # position -> first cell; one more at the end
    default: np.ndarray  # position -> the cell of zero


class Block(NamedTuple):
    """Rows of one training block, as columns: ``rows[ptr[c]:ptr[c + 1]]`` are the rows in cell ``c``; rows in a default cell are left out."""

    ptr: np.ndarray
    rows: np.ndarray
    label: np.ndarray  # -1 or 1
    score: np.ndarray  # sum of the trees so far


class Tree(NamedTuple):
    """Nodes by number; the right child follows the left one."""

    place: np.ndarray  # position of the split's slot
    cell: np.ndarray  # last cell that goes left
    left: np.ndarray  # -1 for leaves
    value: np.ndarray
    levels: list[list[int]]  # split nodes by level


class Settings(NamedTuple):
    depth: int
    least: int  # rows of a child
    min_gain: float


class Binned(NamedTuple):
    blocks: RDD
    bins: Bins
    shared: Broadcast
    width: int
    filled: int  # slots that are not zero, in all rows

    def release(self) -> None:
        self.blocks.unpersist()
        self.shared.unpersist()


def covers(est: GBTClassifier, train: DataFrame) -> bool:
    """Whether ``fit`` knows all settings of ``est`` and the kinds of its slots; other fits are left to ``est.fit``."""
    plain = {"lossType": "logistic", "impurity": "variance", "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minWeightFractionPerNode": 0.0}
    kinds = train.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (all(est.getOrDefault(k) == v for k, v in plain.items()) and not {"nominal", "binary"} & set(kinds) and est.getMaxDepth() > 0
            and not any(est.isDefined(p) and est.getOrDefault(p) for p in ("weightCol", "validationIndicatorCol")))


def slot_thresholds(values: np.ndarray, counts: np.ndarray, rows: int, limit: int) -> np.ndarray:
    """Thresholds of a slot from its distinct values but zero, ascending, and their counts: between any two values
    if ``limit`` is enough, else those nearest to equal shares of the rows."""
    zeros = rows - int(counts.sum())
    if zeros > 0:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= limit:
        return between
    upto = np.cumsum(counts, dtype=float)
    middle = (upto[:-1] + upto[1:]) / 2.0  # a target below it is nearer to the rows before the gap
    out, target, at = [], rows / (limit + 1), 0
    while (at := max(at, int(np.searchsorted(middle, target, side="right")))) < len(between):
        out.append(between[at])
        target, at = target + rows / (limit + 1), at + 1
    return np.array(out)


def _thresholds(train: DataFrame, features: str, rows: int, limit: int) -> tuple[dict[int, np.ndarray], int]:
    """Thresholds by slot, and the number of filled slots."""
    v = F.unwrap_udt(features)
    slots = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))  # a dense vector has no indices
    cells = train.select(F.inline(F.arrays_zip(slots.alias("slot"), v["values"].alias("value")))).toDF("slot", "value").where("value != 0")
    counted = cells.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("p"))

    def each(batches):
        for batch in batches:
            found = []
            for slot, values, counts in zip(*(batch.column(c) for c in ("slot", "values", "counts"))):
                values, counts = values.values.to_numpy(), counts.values.to_numpy()
                if not np.isfinite(values).all():
                    raise ValueError(f"slot {slot} holds NaN or infinite values")
                found.append({"slot": slot.as_py(), "filled": int(counts.sum()), "thresholds": slot_thresholds(values, counts, rows, limit).tolist()})
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=pa.schema({"slot": pa.int32(), "filled": pa.int64(), "thresholds": pa.list_(pa.float64())}))

    out = pairs.select("slot", pairs.p["value"].alias("values"), pairs.p["n"].alias("counts")).mapInArrow(each, "slot int, filled long, thresholds array<double>").collect()
    return {r["slot"]: np.array(r["thresholds"]) for r in out if r["thresholds"]}, sum(r["filled"] for r in out)


def _bins(by_slot: dict[int, np.ndarray], width: int) -> Bins:
    slots = np.array(sorted(by_slot), dtype=np.int64)
    place = np.full(width, -1, dtype=np.int64)
    place[slots] = np.arange(len(slots))
    thresholds = [by_slot[s] for s in slots]
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in thresholds], dtype=np.int64)]).astype(np.int64)
    zero = np.array([np.searchsorted(t, 0.0) for t in thresholds], dtype=np.int64)
    return Bins(place, slots, thresholds, first, first[:-1] + zero)


def _block(vectors: list, labels: list[float], bins: Bins) -> Block:
    indices = [v.indices if hasattr(v, "indices") else np.arange(len(v)) for v in vectors]
    place = bins.place[np.concatenate(indices)]
    rows = np.repeat(np.arange(len(labels), dtype=np.uint16), [len(i) for i in indices])
    order = np.argsort(place.astype(np.int32), kind="stable")
    order = order[np.searchsorted(place[order], 0):]  # without the slots that have no thresholds
    place, rows, values = place[order], rows[order], np.concatenate([v.values for v in vectors])[order]
    cell = np.empty(len(place), dtype=np.int64)
    edges = np.searchsorted(place, np.arange(len(bins.slots) + 1))
    for j in np.flatnonzero(np.diff(edges)):
        a, b = edges[j], edges[j + 1]
        cell[a:b] = bins.first[j] + np.searchsorted(bins.thresholds[j], values[a:b])
    filled = cell != bins.default[place]
    cell, rows = cell[filled], rows[filled]
    order = np.argsort(cell, kind="stable")
    ptr = np.searchsorted(cell[order], np.arange(bins.first[-1] + 1)).astype(np.int32)
    return Block(ptr, rows[order], np.where(np.array(labels) > 0, 1.0, -1.0), np.zeros(len(labels)))


def _blocks(part, bins: Bins, features: str, label: str, most_rows: int, most_entries: int):
    vectors, labels, size = [], [], 0
    for r in part:
        vectors.append(r[features])
        labels.append(r[label])
        size += len(vectors[-1].values)
        if len(labels) == most_rows or size >= most_entries:
            yield _block(vectors, labels, bins)
            vectors, labels, size = [], [], 0
    if labels:
        yield _block(vectors, labels, bins)


def bin_rows(est: GBTClassifier, train: DataFrame) -> Binned | None:
    """The binned rows of ``train``, persisted; None where ``est.fit`` has to judge the rows: no rows, or labels or vectors it refuses."""
    features, label = est.getFeaturesCol(), est.getLabelCol()
    facts = train.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label).isin(0.0, 1.0) & F.col(features).isNotNull()).alias("fine")).first()
    if not facts["n"] or facts["fine"] != facts["n"]:
        return None
    sc = train.sparkSession.sparkContext
    width = len(train.select(features).first()[0])
    by_slot, filled = _thresholds(train, features, facts["n"], min(est.getMaxBins(), facts["n"]) - 1)
    if not by_slot:
        return None
    bins = _bins(by_slot, width)
    shared = sc.broadcast(bins)
    cores = sc.defaultParallelism
    wanted = 1 if filled <= ENTRIES_IN_ONE else -(-filled // ENTRIES_PER_TASK)
    tasks = max(d for d in range(1, cores + 1) if cores % d == 0 and d <= wanted)  # equal shares of the frame's partitions
    most = BLOCK_ROWS, BLOCK_ENTRIES
    blocks = train.select(features, label).coalesce(tasks).rdd.mapPartitions(lambda part: _blocks(part, shared.value, features, label, *most))
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(blocks, bins, shared, width, filled)


def _targets(block: Block, first: bool) -> np.ndarray:
    """What the next tree fits: the labels, then the loss's falling slope."""
    return block.label if first else 4.0 * block.label / (1.0 + np.exp(2.0 * block.label * block.score))


def _reached(block: Block, bins: Bins, tree: Tree) -> np.ndarray:
    """The node of ``tree`` where each row ends."""
    node = np.zeros(len(block.label), dtype=np.int32)
    by_default = (tree.left >= 0) & (bins.default[tree.place] > tree.cell)
    for level in tree.levels:
        right = by_default[node]
        for k in level:
            j = tree.place[k]
            low, cut, high = block.ptr[bins.first[j]], block.ptr[tree.cell[k] + 1], block.ptr[bins.first[j + 1]]
            here = block.rows[low:high]
            mine = node[here] == k
            right[here[mine]] = np.arange(low, high)[mine] >= cut
        node = np.where(tree.left[node] >= 0, tree.left[node] + right, node)
    return node


def _variance(t) -> float:
    """Of a node's rows, by their number, sum and sum of squares."""
    return float((t[2] - t[1] * t[1] / t[0]) / t[0])


def _node_sums(at: np.ndarray, target: np.ndarray, nodes: int) -> np.ndarray:
    return np.stack([np.bincount(at, w, nodes) for w in (None, target, target * target)]).astype(float)


def _sums(blocks, bins: Bins, tree: Tree, nodes: list[int], first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sums of targets of a task's blocks by (node, cell), without the default cells, and the nodes' totals.

    A block's largest node gets what the other rows leave of the whole block, whose cells lie in order."""
    cells, k = int(bins.first[-1]), len(nodes)
    place = np.full(len(tree.left), k, dtype=np.int32)  # k: rows of finished leaves
    place[nodes] = np.arange(k)
    sums, totals = np.zeros((2, k, cells)), np.zeros((3, k))
    for block in blocks:
        at, target = place[_reached(block, bins, tree)], _targets(block, first)
        totals += _node_sums(at, target, k + 1)[:, :k]
        largest = int(np.bincount(at, minlength=k + 1).argmax())
        sizes = np.diff(block.ptr)
        some = np.flatnonzero((at != largest)[block.rows])
        rows = block.rows[some]
        node = at[rows].astype(np.int64)
        key = node * cells + np.repeat(np.arange(cells, dtype=np.int32), sizes)[some]
        if largest == k:
            wanted = node < k
            key, rows = key[wanted], rows[wanted]
        others = np.stack([np.bincount(key, w, (k + 1) * cells).reshape(k + 1, cells) for w in (None, target[rows])]).astype(float)  # no rows: integers
        if largest < k:
            filled = np.flatnonzero(sizes)
            whole = np.zeros((2, cells))
            whole[0] = sizes
            if len(filled):
                whole[1, filled] = np.add.reduceat(target[block.rows], block.ptr[filled])
            others[:, largest] = whole - others.sum(axis=1)
        sums += others[:, :k]
    return sums, totals


def _best(sums: np.ndarray, totals: np.ndarray, first: np.ndarray, default: np.ndarray, least: int) -> list[tuple]:
    """Per node the first best split of the slots with cells ``first``: gain, cell, rows and sum of its left side; cell -1 without one."""
    rows, total, starts, sizes = totals[0][:, None], totals[1][:, None], first[:-1], np.diff(first)
    n, s = sums
    for a, whole in ((n, rows), (s, total)):
        a[:, default] = whole - np.add.reduceat(a, starts, axis=1)
        for b in range(1, int(sizes.max())):
            at = starts[sizes > b] + b
            a[:, at] += a[:, at - 1]
    ok = (n >= least) & (rows - n >= least)
    ok[:, first[1:] - 1] = False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, (s * s / n + (total - s) ** 2 / (rows - n) - total * total / rows) / rows, -np.inf)
        unit = TIE * (totals[2][:, None] / rows)
        gain = np.where(unit > 0, np.round(gain / unit) * unit, gain)  # sums of another order give the same split
    at = gain.argmax(axis=1)
    return [(float(gain[k, c]), int(c) if ok[k, c] else -1, float(n[k, c]), float(s[k, c])) for k, c in enumerate(at)]


def _level(state: RDD, binned: Binned, tree: Tree, nodes: list[int], first: bool, least: int) -> tuple[np.ndarray, list[tuple]]:
    """Totals and best splits of ``nodes``: one job."""
    shared, edges = binned.shared, binned.bins.first
    tasks = state.getNumPartitions()
    cuts = sorted({int(np.searchsorted(edges, edges[-1] * i / tasks)) for i in range(tasks + 1)})  # ranges of slots of about equal cells

    def parts(blocks):
        sums, totals = _sums(blocks, shared.value, tree, nodes, first)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield i, (sums[:, :, shared.value.first[a]:shared.value.first[b]].copy(), totals)

    def best(item):
        i, (sums, totals) = item
        bins, (a, b) = shared.value, cuts[i:i + 2]
        low = int(bins.first[a])
        return i, totals, [(g, c + low if c >= 0 else -1, n, s) for g, c, n, s in _best(sums, totals, bins.first[a:b + 1] - low, bins.default[a:b] - low, least)]

    found = sorted(state.mapPartitions(parts).reduceByKey(lambda x, y: (x[0] + y[0], x[1] + y[1]), len(cuts) - 1).map(best).collect(), key=lambda x: x[0])
    return found[0][1], [max(of_node, key=lambda x: x[0]) for of_node in zip(*[splits for _, _, splits in found])]  # the first of equal gains


class _Growing:
    """A tree while it grows, on the driver: per node its split, children, totals (rows, sum, sum of squares), gain and impurity."""

    def __init__(self):
        self.place, self.cell, self.left, self.totals, self.gain, self.impurity, self.levels = [], [], [], [], [], [], []
        self.add(math.nan, math.nan)

    def add(self, rows: float, total: float) -> int:
        for values, v in ((self.place, 0), (self.cell, -1), (self.left, -1), (self.gain, math.nan), (self.impurity, math.nan)):
            values.append(v)
        self.totals.append([rows, total, math.nan])
        return len(self.left) - 1

    def complete(self, totals: np.ndarray) -> None:
        """What leaves lack that no level looked at."""
        for k, t in enumerate(totals.T):
            if math.isnan(self.totals[k][2]):
                self.totals[k][2] = float(t[2])
            if math.isnan(self.impurity[k]):
                self.impurity[k] = _variance(t)

    def tree(self) -> Tree:
        value = np.array([t[1] / t[0] if t[0] else 0.0 for t in self.totals])
        return Tree(np.array(self.place), np.array(self.cell), np.array(self.left), value, [list(x) for x in self.levels])


def _grow(level, bins: Bins, settings: Settings) -> _Growing:
    """One tree, level by level, as ``GBTClassifier`` grows it; ``level`` gives the totals and best splits of some nodes."""
    out, active = _Growing(), [0]
    at_once = max(1, SUMS_BYTES // (16 * int(bins.first[-1])))
    for _ in range(settings.depth):
        tree, split = out.tree(), []
        for i in range(0, len(active), at_once):
            nodes = active[i:i + at_once]
            totals, best = level(tree, nodes)
            for k, (gain, cell, rows, total), t in zip(nodes, best, totals.T):
                out.totals[k] = [float(x) for x in t]
                impurity = _variance(t)
                if k and abs(impurity) < EPSILON:
                    continue  # its parent made it a leaf
                if cell < 0 or gain < settings.min_gain:
                    out.impurity[k] = -1.0
                    continue
                out.impurity[k] = impurity
                if gain > 0:
                    out.place[k], out.cell[k], out.gain[k] = int(np.searchsorted(bins.first, cell, side="right")) - 1, cell, gain
                    out.left[k] = out.add(rows, total)
                    out.add(float(t[0] - rows), float(t[1] - total))
                    split.append(k)
        if not split:
            break
        out.levels.append(split)
        active = [c for k in split for c in (out.left[k], out.left[k] + 1)]
    return out


def _leaf_totals(blocks, bins: Bins, tree: Tree, first: bool) -> np.ndarray:
    return sum(_node_sums(_reached(b, bins, tree), _targets(b, first), len(tree.left)) for b in blocks)


def _next_tree(state: RDD, binned: Binned, settings: Settings, first: bool) -> _Growing:
    """The tree that the blocks' targets give.  One task's blocks need one job, else each level is one, and the leaves' totals."""
    shared = binned.shared
    if state.getNumPartitions() == 1:
        def whole(part):
            blocks, bins = list(part), shared.value

            def level(tree, nodes):
                sums, totals = _sums(blocks, bins, tree, nodes, first)
                return totals, _best(sums, totals, bins.first, bins.default, settings.least)

            made = _grow(level, bins, settings)
            made.complete(_leaf_totals(blocks, bins, made.tree(), first))
            yield made
        return state.mapPartitions(whole).collect()[0]
    made = _grow(lambda tree, nodes: _level(state, binned, tree, nodes, first, settings.least), binned.bins, settings)
    tree = made.tree()
    made.complete(state.mapPartitions(lambda part: [_leaf_totals(part, shared.value, tree, first)]).treeReduce(lambda a, b: a + b))
    return made


def _scored(blocks: RDD, shared: Broadcast, trees: list[tuple[Tree, float]]) -> RDD:
    """The blocks with the scores of ``trees`` added."""
    def one(block: Block) -> Block:
        return block._replace(score=block.score + sum(weight * tree.value[_reached(block, shared.value, tree)] for tree, weight in trees))
    return blocks.map(one)


def fit(est: GBTClassifier, binned: Binned) -> GBTClassificationModel:
    """What ``est.fit`` returns, from the rows of ``bin_rows``."""
    settings = Settings(est.getMaxDepth(), est.getMinInstancesPerNode(), est.getMinInfoGain())
    state, before, grown, trees = binned.blocks, None, [], []
    try:
        for i in range(est.getMaxIter()):
            grown.append(_next_tree(state, binned, settings, i == 0))
            trees.append((grown[-1].tree(), 1.0 if i == 0 else est.getStepSize()))
            if before is not None:
                before.unpersist()
            before = state if state is not binned.blocks else None
            again = len(trees) % REBUILD_ROUNDS == 0
            state = _scored(binned.blocks if again else state, binned.shared, trees[:] if again else trees[-1:]).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for x in (before, state):
            if x is not None and x is not binned.blocks:
                x.unpersist()
    return _model(est, binned, grown, [w for _, w in trees])


def _model(est: GBTClassifier, binned: Binned, grown: list[_Growing], weights: list[float]) -> GBTClassificationModel:
    sc = SparkContext._active_spark_context
    jvm, ml = sc._jvm, sc._jvm.org.apache.spark.ml
    leaf, inner, cut, kept = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    copy, regression = jvm.java.util.Arrays.copyOfRange, ml.regression.DecisionTreeRegressionModel
    trees = sc._gateway.new_array(regression, len(grown))
    steps = sc._gateway.new_array(jvm.double, len(grown))
    bins = binned.bins
    for i, g in enumerate(grown):
        flat = sc._gateway.new_array(jvm.double, 3 * len(g.totals))
        jvm.java.nio.ByteBuffer.wrap(np.array(g.totals, dtype=">f8").tobytes()).asDoubleBuffer().get(flat)
        value, nodes = g.tree().value, {}
        for k in range(len(g.left) - 1, -1, -1):  # children before their parents
            stats = kept(copy(flat, 3 * k, 3 * k + 3), int(g.totals[k][0]))
            a = g.left[k]
            if a < 0:
                nodes[k] = leaf(float(value[k]), g.impurity[k], stats), True, float(value[k])
                continue
            (left, left_ends, x), (right, right_ends, y) = nodes.pop(a), nodes.pop(a + 1)
            if left_ends and right_ends and x == y:  # two leaves that say the same are one
                nodes[k] = leaf(x, g.impurity[k], stats), True, x
                continue
            j = g.place[k]
            at = float(bins.thresholds[j][g.cell[k] - bins.first[j]])
            nodes[k] = inner(float(value[k]), g.impurity[k], g.gain[k], left, right, cut(int(bins.slots[j]), at), stats), False, 0.0
        trees[i] = regression(f"{est.uid}_{i}", nodes[0][0], binned.width)
        steps[i] = weights[i]
    made = GBTClassificationModel(ml.classification.GBTClassificationModel(f"{est.uid}_model", trees, steps, binned.width, 2))
    made._resetUid(est.uid)
    return est._copyValues(made)
