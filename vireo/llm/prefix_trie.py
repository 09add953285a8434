"""Operator 13: conversation prefix trie, a z-fast trie.

A conversation is the string of its turns.  A turn counts by a digest of role,
text and its place; a prefix counts by the exclusive or of its turns' digests
(128 bits), so equal prefixes have equal keys and a string's keys tell in one
comparison whether two strings agree up to a depth.

Conversations are dealt to parts of about ``PART_TURNS`` turns, and each part is
a compacted trie: a node stands for an edge, the run of depths from its name to
its extent.  A dictionary finds a node by its handle, the prefix whose length is
the two-fattest number of the node's run (the one that the largest power of two
divides).  A conversation's exit node is located by fat binary search over
prefix lengths, in logarithmically many lookups; strings are inserted in
batches, equal ones of a batch once.  Then edges are expanded: each part returns
a row for every depth of every edge.  Parts meet by the prefixes' keys, so a
prefix that all conversations share costs one row a part, and what a node needs
from its whole subtree is summed inside the parts, each node's share in the part
of its smallest member, and then over the parts.

Turns are ranked inside a conversation over range partitions, and a string longer
than ``CHUNK`` turns is cut: the later pieces hang below the key of what comes
before, and the sums of a piece are handed up over the pieces of its
conversation.  So neither a conversation with a third of all turns nor a turn
with a third of all conversations meets in one task.  Members' ids are joined to
blocks where they lie, sorted, and one task hashes a node's blocks as they pass.

Defined cases: null role or text is empty; turns are ordered by number, null
first, equal numbers by the digest of role and text, and a repeated row is a turn of
its own; rows with a null conversation id belong to no conversation; a
conversation without turns ends at the root; an empty table has no nodes; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import WORD, stored, text_of
from vireo.operators.joins import join_group_table

#: Turns of one part (one trie in memory), and longest string that a trie takes in one piece.
PART_TURNS, CHUNK = 100_000, 4096
#: Ids of one block of an end node's list.
BLOCK_IDS = 4096
#: Rows of one Arrow batch that a part returns.
OUT_ROWS = 50_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- one trie

def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie over strings of prefix keys (16 bytes for each depth), found by handles."""

    def __init__(self):
        # node 0 is the root: the empty run that ends at depth 0
        self.start, self.end, self.up, self.rep = [0], [0], [-1], [b""]
        self.count, self.least = [0], [None]  # strings that end at the node, smallest id of them
        self.words: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.handle: dict[bytes, int] = {}
        self.name: dict[bytes, int] = {}

    @staticmethod
    def _key(keys: bytes, depth: int) -> bytes:
        return keys[16 * (depth - 1):16 * depth]

    def _node(self, start: int, end: int, up: int, keys: bytes, words: np.ndarray) -> int:
        for column, value in zip((self.start, self.end, self.up, self.rep, self.count, self.least, self.words), (start, end, up, keys, 0, None, words)):
            column.append(value)
        node = len(self.start) - 1
        self.name[self._key(keys, start)] = node
        self.handle[self._key(keys, two_fattest(start - 1, end))] = node
        return node

    def locate(self, keys: bytes) -> tuple[int, int]:
        """(exit node, depth up to which the string agrees with it), by fat binary search."""
        low, high, node = 0, len(keys) // 16, 0
        size = high
        while low < high:
            fat = two_fattest(low, high)
            found = self.handle.get(self._key(keys, fat))
            if found is None:
                high = fat - 1
            else:
                node, low = found, self.end[found]
        # the string may leave an edge above its handle: then the search ends at the node above
        if self.end[node] < size and (child := self.name.get(self._key(keys, self.end[node] + 1))) is not None:
            node = child
        low, high = max(self.start[node] - 1, 0), min(self.end[node], size)
        while low < high:
            mid = (low + high + 1) // 2
            if self._key(keys, mid) == self._key(self.rep[node], mid):
                low = mid
            else:
                high = mid - 1
        return node, low

    def _split(self, node: int, depth: int) -> int:
        """Cut the node's run after ``depth``; the new upper node."""
        keys, start, end = self.rep[node], self.start[node], self.end[node]
        del self.handle[self._key(keys, two_fattest(start - 1, end))]
        upper = self._node(start, depth, self.up[node], keys, self.words[node])
        self.start[node], self.up[node] = depth + 1, upper
        self.name[self._key(keys, depth + 1)] = node
        self.handle[self._key(keys, two_fattest(depth, end))] = node
        return upper

    def insert(self, keys: bytes, words: np.ndarray, times: int, least: int) -> None:
        node, depth = self.locate(keys)
        size = len(keys) // 16
        if depth < self.end[node]:
            node = self._split(node, depth)
        if depth < size:
            node = self._node(depth + 1, size, node, keys, words)
        self.count[node] += times
        self.least[node] = least if self.least[node] is None else min(least, self.least[node])

    def insert_batch(self, strings: list[tuple[bytes, np.ndarray, int]]) -> None:
        """Insert (keys, words, id) strings; equal ones once, with their number and smallest id."""
        distinct: dict[tuple[int, bytes], list] = {}
        for keys, words, member in strings:
            seen = distinct.setdefault((len(keys), keys[-16:]), [keys, words, 0, member])
            seen[2] += 1
            seen[3] = min(seen[3], member)
        for one in distinct.values():
            self.insert(*one)

    def expanded(self, offset: tuple[int, int], base: int) -> dict[str, np.ndarray]:
        """A row for every depth of every edge, parents first, a subtree's rows together.

        ``base`` is the depth and ``offset`` the key at which this trie hangs (0 and (0, 0) for whole strings).
        """
        nodes = len(self.start)
        kids: list[list[int]] = [[] for _ in range(nodes)]
        for node in range(1, nodes):
            kids[self.up[node]].append(node)
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += kids[node]
        total, least = list(self.count), list(self.least)
        rows = [max(self.end[n] - self.start[n] + 1, 1) if n else 1 for n in range(nodes)]
        below = list(rows)
        for node in reversed(order[1:]):
            up = self.up[node]
            total[up] += total[node]
            below[up] += below[node]
            if least[node] is not None:
                least[up] = least[node] if least[up] is None else min(least[up], least[node])
        width = np.array([rows[n] for n in order], dtype=np.int64)
        first = np.cumsum(width) - width
        at = dict(zip(order, first.tolist()))
        n = int(width.sum())
        out = {c: np.zeros(n, np.int64) for c in ("depth", "a", "b", "pa", "pb", "low", "n", "words", "size", "up")}
        for node, lo in zip(order, first.tolist()):
            r = rows[node]
            hi = lo + r
            out["low"][lo:hi], out["n"][lo:hi] = least[node] or 0, total[node]
            out["size"][lo:hi] = below[node] - np.arange(r)
            out["up"][lo:hi] = np.arange(lo - 1, hi - 1)
            if not node:
                out["depth"][lo], out["a"][lo], out["b"][lo], out["up"][lo] = base, *offset, -1
                continue
            up = self.up[node]
            out["up"][lo] = at[up] + rows[up] - 1
            start, end = self.start[node], self.end[node]
            keys = np.frombuffer(self.rep[node], dtype=np.int64).reshape(-1, 2)
            out["depth"][lo:hi] = base + np.arange(start, end + 1)
            out["a"][lo:hi], out["b"][lo:hi] = keys[start - 1:end].T
            out["pa"][lo + 1:hi], out["pb"][lo + 1:hi] = keys[start - 1:end - 1].T
            out["pa"][lo], out["pb"][lo] = keys[start - 2] if start > 1 else offset
            out["words"][lo:hi] = self.words[node][start - 1:end]
        return out


# ---------------------------------------------------------------- ordered turns

def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Stored (conv, sha, words, n, below): every distinct turn with its number of rows and how many turns come before it.

    Only digests are shuffled.  Rows are ranked over range partitions; a conversation that crosses ranges, at
    most one at each bound, gets its offset from a table with a row for each range.
    """
    role, text = text_of(role_col), text_of(text_col)
    sha = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, 16)
    slim = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.struct(F.col(turn_col).alias("turn"), sha.alias("sha")).alias("at"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    distinct = slim.groupBy("conv", "at").agg(F.count("*").alias("n"), F.max("words").alias("words"))
    ranged = stored(distinct.repartitionByRange("conv", "at").withColumn("range", F.spark_partition_id()), "turn-ranges")
    totals = ranged.groupBy("conv", "range").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("conv", "range", before.alias("earlier")).where("earlier IS NOT NULL")  # fewer rows than ranges
    inside = F.sum("n").over(Window.partitionBy("conv", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    ranked = ranged.join(F.broadcast(offsets), ["conv", "range"], "left").withColumn("inside", inside)
    below = F.coalesce("earlier", F.lit(0)) + F.coalesce("inside", F.lit(0))
    return stored(ranked.select("conv", F.col("at.sha").alias("sha"), "words", "n", below.alias("below")), "turns")


def _copies(first: Column, last: Column) -> Column:
    return F.explode(F.when(first <= last, F.sequence(first, last)))


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(string rows (conv, d, sha, words), convs (conv, turns)) of the conversations as they are."""
    convs = turns.groupBy("conv").agg(F.sum("n").alias("turns"))
    return turns.select("conv", _copies(F.col("below") + 1, F.col("below") + F.col("n")).alias("d"), "sha", "words"), convs


def rebuilt(turns: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Like ``plain``, for conversations that begin with the first turns of their block's first conversation.

    Conversation c takes the first h turns of conversation c - c % ``block`` in place of its own first h,
    h = crc32(c as text) % ``heads``.
    """
    convs = turns.groupBy("conv").agg(F.sum("n").alias("turns"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % block).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % heads)
    bases = convs.where("conv = base").select("base", F.col("turns").alias("given"))
    table = convs.join(bases, "base", "left").withColumn("used", F.least("h", F.coalesce("given", F.lit(0)))).drop("given")
    table = stored(table.withColumn("left", F.greatest(F.col("turns") - F.col("h"), F.lit(0))), "conversations")
    first = turns.where((F.col("conv") % block == 0) & (F.col("below") < heads - 1))
    first = first.select(F.col("conv").alias("base"), _copies(F.col("below") + 1, F.least(F.col("below") + F.col("n"), F.lit(heads - 1))).alias("d"), "sha", "words")
    taken = table.where("used > 0").join(first, "base").where("d <= used").select("conv", "d", "sha", "words")
    own = join_group_table(turns, table.select("conv", "h", "used", F.col("turns").alias("rows")), ["conv"], "inner", size_col="rows")
    own = own.select("conv", _copies(F.greatest(F.col("below"), F.col("h")) + 1, F.col("below") + F.col("n")).alias("pos"), "h", "used", "sha", "words")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("used")).alias("d"), "sha", "words")
    return taken.union(own), table.select("conv", (F.col("used") + F.col("left")).alias("turns"))


# ---------------------------------------------------------------- strings and parts

def _strings(rows: DataFrame, convs: DataFrame, chunk: int) -> tuple[DataFrame, bool]:
    """Stored (conv, chunk, turns, xa, xb, oa, ob): pieces of at most ``chunk`` turns, their digests' exclusive or and that of what is before."""
    hashed = rows.select("conv", "d", F.xxhash64(F.lit(1), "d", "sha").alias("a"), F.xxhash64(F.lit(2), "d", "sha").alias("b"), "words")
    pieces = hashed.groupBy("conv", F.expr(f"(d - 1) div {chunk}").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("d", "a", "b", "words"))).alias("turns"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    blank = convs.where("turns = 0").select("conv", F.lit(0).cast("long").alias("chunk"), F.lit(None).cast(pieces.schema["turns"].dataType).alias("turns"),
                                            *[F.lit(0).cast("long").alias(c) for c in ("xa", "xb")])
    whole = stored(pieces.union(blank), "strings")
    zero = [F.lit(0).cast("long").alias(c) for c in ("oa", "ob")]
    if whole.where("chunk > 0").isEmpty():
        return whole.select("*", *zero), False
    # only conversations of several pieces have anything before a piece
    several = whole.join(whole.where("chunk = 1").select("conv"), "conv", "left_semi").select("conv", "chunk", "xa", "xb")
    over = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = several.select("conv", "chunk", *[F.bit_xor(x).over(over).alias(o) for x, o in (("xa", "oa"), ("xb", "ob"))])
    later = whole.join(before.where("chunk > 0"), ["conv", "chunk"])
    return stored(later.unionByName(whole.where("chunk = 0").select("*", *zero)), "strings"), True


_NODE = "part int, seq long, chunk long, depth long, a long, b long, pa long, pb long, low long, n long, words long, size long, up long"
_NUMBERS = ("depth", "a", "b", "pa", "pb", "low", "n", "words", "size", "up")


def _nodes(strings: DataFrame, block: int, chunk: int, part_turns: int) -> tuple[DataFrame, int]:
    """Stored rows of every part's expanded trie, and the number of parts."""
    total = strings.agg(F.sum(F.coalesce(F.size("turns"), F.lit(0))).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // part_turns))
    where = F.pmod(F.xxhash64(F.col("conv") - F.col("conv") % block, "chunk"), F.lit(parts)).cast("int")
    dealt = strings.select(where.alias("part"), "chunk", "oa", "ob", "conv", "turns").repartition(parts, "part").sortWithinPartitions("part", "chunk", "oa", "ob", "conv")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, trie, root = None, 0, None, None

        def rows():
            nonlocal seq
            k, oa, ob = root
            out = trie.expanded((oa, ob), k * chunk)
            n = len(out["depth"])
            hanging = np.arange(n) == 0 if k else np.zeros(n, bool)  # a hanging root is the node of an earlier piece, counted there
            out["n"][hanging] = 0
            out["up"] = np.where(out["up"] < 0, -1, out["up"] + seq)
            top = out["depth"] == 0
            for lo in range(0, n, OUT_ROWS):
                cut = slice(lo, min(lo + OUT_ROWS, n))
                size = cut.stop - lo
                columns = [pa.array(out[c][cut], mask=(hanging | (top if c in ("pa", "pb") else False))[cut] if c in ("pa", "pb", "low") else None) for c in _NUMBERS]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, part, np.int32)), pa.array(np.arange(seq + lo, seq + lo + size)), pa.array(np.full(size, k)), *columns],
                                                 ["part", "seq", "chunk", *_NUMBERS])
            seq += n

        for batch in batches:
            lists = batch.column("turns")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            a, b, words = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "words"))
            ends = np.cumsum(sizes)
            heads = list(zip(*[batch.column(c).to_pylist() for c in ("part", "chunk", "oa", "ob", "conv")]))
            held = []
            for i, (p, k, oa, ob, conv) in enumerate(heads):
                if (p, (k, oa, ob)) != (part, root):
                    if trie is not None:
                        trie.insert_batch(held)
                        yield from rows()
                    held, seq = [], seq if p == part else 0
                    part, root, trie = p, (k, oa, ob), ZFastTrie()
                lo, hi = ends[i] - sizes[i], ends[i]
                # the keys of all prefixes: running exclusive ors from the key of what is before the piece
                keys = np.bitwise_xor.accumulate(np.stack([a[lo:hi], b[lo:hi]], axis=1), axis=0) ^ np.array([oa, ob]) if hi > lo else np.zeros((0, 2), np.int64)
                held.append((keys.astype(np.int64).tobytes(), words[lo:hi], conv))
            if held:
                trie.insert_batch(held)
        if trie is not None:
            yield from rows()

    return stored(dealt.mapInArrow(build, _NODE), "trie-nodes"), parts


def _below(info: DataFrame, strings: DataFrame, chunk: int) -> DataFrame:
    """(depth, a, b, more_leaves, more_saved): what hangs below the nodes at which long strings were cut.

    A node's share belongs to its smallest member; the shares of a conversation's later pieces add up along its pieces.
    """
    share = info.where("depth > 0").groupBy(F.col("low").alias("conv"), F.expr(f"(depth - 1) div {chunk}").alias("chunk")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    later = strings.where("chunk > 0").select("conv", "chunk", "oa", "ob").join(share, ["conv", "chunk"], "left")
    on = Window.partitionBy("conv").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, 0)
    tails = later.select((F.col("chunk") * chunk).alias("depth"), F.col("oa").alias("a"), F.col("ob").alias("b"), *[F.sum(F.coalesce(c, F.lit(0))).over(on).alias(c) for c in ("leaf", "saved")])
    return tails.groupBy("depth", "a", "b").agg(F.sum("leaf").alias("more_leaves"), F.sum("saved").alias("more_saved"))


_SUM = "depth long, a long, b long, parent long, leaves long, saved long"


def _subtree_sums(rows: DataFrame, parts: int) -> DataFrame:
    """Each part's share of every node's subtree sums, and the parent's smallest member."""
    dealt = rows.repartition(parts, "part").sortWithinPartitions("part", "seq")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def summed():
            table = pa.Table.from_batches(held)
            column = {c: table.column(c).to_numpy() for c in ("size", "up", "low", "leaf", "saved")}
            seq = np.arange(table.num_rows)
            out = [table.column(c).combine_chunks() for c in ("depth", "a", "b")]
            parent = column["low"][np.maximum(column["up"], 0)]
            out.append(pa.array(parent, mask=column["up"] < 0))
            for c in ("leaf", "saved"):
                running = np.concatenate(([0], np.cumsum(column[c])))
                out.append(pa.array(running[seq + column["size"]] - running[seq]))
            result = pa.RecordBatch.from_arrays(out, ["depth", "a", "b", "parent", "leaves", "saved"])
            yield result.filter(pa.array(~table.column("hanging").to_numpy(zero_copy_only=False)))

        for batch in batches:
            p = batch.column("part").to_numpy()
            change = np.flatnonzero(p[1:] != p[:-1]) + 1
            for lo, hi in zip([0, *change], [*change, len(p)]):
                if hi > lo and p[lo] != part:
                    if held:
                        yield from summed()
                    part, held = p[lo], []
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from summed()

    return dealt.mapInArrow(sums, _SUM)


def _end_digests(strings: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes at which conversations end: their ids ascending, joined by commas."""
    ends = strings.groupBy("conv").agg(F.sum(F.coalesce(F.size("turns"), F.lit(0))).cast("long").alias("depth"), F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b"))
    key = ["depth", "a", "b"]
    ranged = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")

    def runs(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[tuple, int, int]]:
        at = [batch.column(c).to_numpy() for c in key]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in at], axis=0)) + 1
        for lo, hi in zip([0, *change], [*change, batch.num_rows]):
            for first in range(lo, hi, limit):
                yield tuple(int(c[lo]) for c in at), first, min(first + limit, hi)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv = batch.column("conv").to_pylist()
            rows = [(*node, conv[lo], ",".join(map(str, conv[lo:hi]))) for node, lo, hi in runs(batch, BLOCK_IDS)] if batch.num_rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*key, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hasher = None, None
        for batch in batches:
            done, ids = [], batch.column("ids")
            for i, now in enumerate(zip(*[batch.column(c).to_pylist() for c in key])):
                if now != node:
                    if hasher:
                        done.append((*node, hasher.hexdigest()))
                    node, hasher = now, hashlib.sha256(ids[i].as_py().encode())
                else:
                    hasher.update(b"," + ids[i].as_py().encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*key, "ends_sha256"])
        if hasher:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, hasher.hexdigest())], [*key, "ends_sha256"])

    made = ranged.mapInArrow(blocks, "depth long, a long, b long, first long, ids string")
    return made.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digests, "depth long, a long, b long, ends_sha256 string")


def conversation_trie(rows: DataFrame, convs: DataFrame, block: int = 20, chunk: int = CHUNK, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per distinct prefix of the strings ``rows`` (conv, d, sha, words) of the conversations ``convs`` (conv, turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes
    below or at it), saved_tokens (words of the last turn times members but one, summed below and at it),
    ends_sha256 (members that end there).  Conversations of one ``block`` of ids go to one part.
    """
    strings, cut = _strings(rows, convs, chunk)
    local, parts = _nodes(strings, block, chunk, part_turns)
    key = ["depth", "a", "b"]
    merged = local.groupBy(*key).agg(F.min("low").alias("low"), F.sum("n").alias("n"), F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    merged = stored(merged, "prefixes")
    kids = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("kids"))
    info = merged.drop("pa", "pb").join(kids, key, "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    info = info.withColumn("leaf", (F.col("kids") == 0).cast("long")).withColumn("saved", (F.col("n") - 1) * F.col("words"))
    shares = info
    if cut:
        shares = info.join(_below(info, strings, chunk), key, "left")
        shares = shares.withColumn("leaf", F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
    own = F.col("local_low").eqNullSafe(F.col("low"))
    met = local.select("part", "seq", "size", "up", *key, F.col("low").alias("local_low")).join(shares.select(*key, "low", "leaf", "saved"), key)
    met = met.select("part", "seq", "size", "up", *key, "low", F.col("local_low").isNull().alias("hanging"),
                     *[F.when(own, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("leaf", "saved")])
    sums = _subtree_sums(met, parts).groupBy(*key).agg(F.max("parent").alias("parent"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    out = info.select(*key, "low", "n", "kids").join(sums, key).join(_end_digests(strings), key, "left")
    return out.select(F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def rebuilt_conversation_trie(conversations: DataFrame) -> DataFrame:
    """The contract's nodes: conversations rebuilt on their block's first one."""
    return conversation_trie(*rebuilt(ordered_turns(conversations)))
