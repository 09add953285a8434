"""Operator 2: near-duplicate documents by BagMinHash over word shingles.

A document is the multiset of its shingles of ``WORDS`` words (a shorter text is
one shingle of all its words).  Its signature estimates the weighted Jaccard
similarity sum(min)/sum(max) without bias: every shingle owns a Poisson process
on each dyadic range of weights (0,1], (1,2], (2,4], (4,8] ...; a weight takes
part with the ranges it covers, and a range that it covers in part is split:
the point found falls into one half, the other half goes on from there.  Points
carry a signature position; the smallest point of each position is the
signature.  Points come in rising order and stop at the largest value still
standing, so the work follows shingles + positions * ln(positions), not their
product.

Equal texts collapse first to one node.  Signatures are cut into bands;
documents that share a band's key are candidates, and the multiset similarity of
each candidate pair is computed from the whole texts.  Pairs are not expanded
inside a bucket: first every member is compared with the bucket's smallest node,
and the links found give components.  A bucket that still holds several
components is then compared in blocks: members outside its largest component
with each other and with that component, a block pair at a time as a product of
shingle incidence matrices, and a block pair returns a spanning forest of its
links.  Both rounds together compare or connect every pair that shares a bucket.

Documents are texts, not ids: the nodes of links and components are content
digests.  A component's representative is one row: the smallest id in it, of
that id the text with the smallest digest, and of repeated rows the smallest by
the other columns.

Defined cases: null text is empty; a text without words links with nothing, not
even with its copies; rows that repeat an id with other texts are compared each
for itself; rows with a null id are left out of the classes, and among representatives a null id counts as the
largest; an empty table gives an empty
result; extra columns only order repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import WORD, byte_slices, mix64, stored, unit, within, word_hashes
from vireo.llm.graph import components

WORDS, SIMILARITY = 5, 0.8
#: What a null id counts as where rows are to stay or go.
NO_ID = (1 << 63) - 1
#: At similarity 0.8 a pair shares a band with probability 1 - (1 - 0.8^6)^26 > 0.9995.
BANDS, ROWS = 26, 6
#: Partners that are compared with one document in one group of a task.
PARTNERS = 512
#: Members and shingles that a block of an open bucket aims at, and columns of one incidence product.
BLOCK_MEMBERS, BLOCK_SHINGLES, COLUMNS = 1024, 1_000_000, 4096

_STEPS = mix64(np.arange(64, dtype=np.uint64) + np.uint64(501)) | np.uint64(1)


def shingles(hashes: np.ndarray, counts: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash in text order, shingles per text); texts without words have none."""
    per = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), per)
    nth = within(per)
    first = (np.cumsum(counts) - counts)[text] + nth
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    with np.errstate(over="ignore"):
        out = np.zeros(len(first), dtype=np.uint64)
        for j in range(words):
            word = padded[first + j]
            if j:
                word = np.where(nth + j < counts[text], word, np.uint64(0))
            out += word * _STEPS[j]
    return mix64(out), per


def bags(hashes: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their weights, and how many each text has; sorted by hash inside a text."""
    keys, weights, sizes = [], [], np.zeros(len(per), dtype=np.int64)
    at = 0
    for i, n in enumerate(per.tolist()):
        if n:
            part = np.sort(hashes[at:at + n])
            at += n
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            keys.append(part[starts])
            weights.append(np.diff(np.append(starts, n)))
            sizes[i] = len(starts)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes
    return np.concatenate(keys), np.concatenate(weights), sizes


def signatures(keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, positions: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, one row per text (infinite for empty texts)."""
    texts = len(sizes)
    best = np.full(texts * positions, np.inf)
    text = np.repeat(np.arange(texts), sizes)
    # one process per element and dyadic range below its weight
    parts = []
    level, chosen = 0, np.arange(len(keys))
    while len(chosen):
        low = 0 if level == 0 else 1 << (level - 1)
        parts.append((chosen, np.full(len(chosen), low), np.full(len(chosen), 1 << level), np.full(len(chosen), level)))
        chosen = chosen[weights[chosen] > (1 << level)]
        level += 1
    if not parts:
        return best.reshape(texts, positions)
    element, lo, hi, lv = (np.concatenate(x) for x in zip(*parts))
    owner, weight = text[element], weights[element]
    with np.errstate(over="ignore"):
        key = mix64(keys[element] + lv.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    x = np.zeros(len(key))
    nth = np.zeros(len(key), dtype=np.uint64)
    limit = np.full(texts, np.inf)
    one, side = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        while len(key):
            draw = mix64(key + nth * one)
            x = x - np.log(unit(draw)) / (hi - lo)
            live = x < limit[owner]
            owner, weight, lo, hi, key, x, nth, draw = (v[live] for v in (owner, weight, lo, hi, key, x, nth, draw))
            slot = owner * positions + (mix64(draw ^ side) % np.uint64(positions)).astype(np.int64)
            counted = hi <= weight
            np.minimum.at(best, slot[counted], x[counted])
            leaf = hi - lo == 1
            waiting = [(owner[leaf], weight[leaf], lo[leaf], hi[leaf], key[leaf], x[leaf], nth[leaf] + np.uint64(1))]
            # a range with a point is split down to the unit that holds the point
            held = ~leaf
            o, w, a, b, k, y, d, s, c = (v[held] for v in (owner, weight, lo, hi, key, x, draw, slot, counted))
            while len(o):
                mid = (a + b) // 2
                d = mix64(d + side)
                right = (d >> np.uint64(40)) & np.uint64(1) == 1
                left_key, right_key = mix64(k ^ side), mix64(k + side)
                other = np.where(right, a, mid) < w
                waiting.append((o[other], w[other], np.where(right, a, mid)[other], np.where(right, mid, b)[other], np.where(right, left_key, right_key)[other], y[other], np.zeros(int(other.sum()), np.uint64)))
                a, b, k = np.where(right, mid, a), np.where(right, b, mid), np.where(right, right_key, left_key)
                inside = a < w
                o, w, a, b, k, y, d, s, c = (v[inside] for v in (o, w, a, b, k, y, d, s, c))
                new = (b <= w) & ~c
                np.minimum.at(best, s[new], y[new])
                c = c | new
                done = b - a == 1
                waiting.append((o[done], w[done], a[done], b[done], k[done], y[done], np.ones(int(done.sum()), np.uint64)))
                o, w, a, b, k, y, d, s, c = (v[~done] for v in (o, w, a, b, k, y, d, s, c))
            owner, weight, lo, hi, key, x, nth = (np.concatenate(v) for v in zip(*waiting))
            limit = best.reshape(texts, positions).max(axis=1)
            live = x < limit[owner]
            owner, weight, lo, hi, key, x, nth = (v[live] for v in (owner, weight, lo, hi, key, x, nth))
    return best.reshape(texts, positions)


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per text and band."""
    texts, positions = signature.shape
    bits = signature.view(np.uint64).reshape(texts, positions // rows, rows)
    with np.errstate(over="ignore"):
        key = mix64(np.arange(positions // rows, dtype=np.uint64) + np.uint64(9001))[None, :] + np.zeros((texts, 1), np.uint64)
        for r in range(rows):
            key = mix64(key ^ bits[:, :, r])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset Jaccard of two bags (sorted keys, weights)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    shared = int(np.minimum(a[1][at[same]], b[1][same]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _keyed(id_col: str, text_col: str, null_ids: bool = False) -> tuple[Column, Column]:
    """(id, digest) of a row: what tells documents apart; with ``null_ids`` a null id counts as the largest."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    number = F.col(id_col).cast("long")
    return (F.coalesce(number, F.lit(NO_ID)) if null_ids else number).alias("id"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest")


def signed(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int, null_ids: bool = False) -> DataFrame:
    """Stored (id, digest, size, keys): content digest, shingles and band keys of every text with words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", 2 << 20):
                hashes, counts = word_hashes(batch.column("text"))
                flat, per = shingles(hashes, counts, words)
                keys = band_keys(signatures(*bags(flat, per), bands * rows), rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
                out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array(per), lists], ["id", "digest", "size", "keys"])
                yield out.filter(pa.array(per > 0))

    source = docs.select(*_keyed(id_col, text_col, null_ids), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    return stored(source.mapInArrow(sign, "id long, digest binary, size long, keys array<long>"), "signatures")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is at least ``least``; partners of one ``a`` are spread over salts."""
    share = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salted = pairs.join(share, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PARTNERS).cast("long")).alias("salt"))
    pivot = salted.select("a", "salt").distinct().join(texts, F.col("a") == F.col("id")).select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    other = salted.join(texts, F.col("b") == F.col("id")).select("a", "salt", "b", "text")
    dealt = pivot.union(other).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for batch in byte_slices(whole, "text", 2 << 20):
                keys, weights, sizes = bags(*shingles(*word_hashes(batch.column("text")), words))
                ends = np.cumsum(sizes)
                found = []
                for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                    bag = keys[ends[i] - sizes[i]:ends[i]], weights[ends[i] - sizes[i]:ends[i]]
                    if b is None:
                        held = bag
                    elif similarity(held, bag) >= least:
                        found.append((a, b))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def block_overlaps(x: list[tuple[np.ndarray, np.ndarray]], y: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Multiset overlaps sum(min) of all bags of ``x`` with all of ``y``.

    A weight w stands for w occurrences, numbered; two bags share min(v, w) of them, so
    the overlaps are a product of 0/1 incidence matrices, taken over columns in turn.
    """
    def incidence(bags):
        row = np.repeat(np.arange(len(bags)), [int(w.sum()) for _, w in bags])
        weight = np.concatenate([w for _, w in bags])
        with np.errstate(over="ignore"):
            return row, mix64(np.repeat(np.concatenate([k for k, _ in bags]), weight) + within(weight).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    (xr, xk), (yr, yk) = incidence(x), incidence(y)
    shared = np.intersect1d(xk, yk)
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    xc, yc = np.searchsorted(shared, xk), np.searchsorted(shared, yk)
    keep = lambda c, k: (c < len(shared)) & (shared[np.minimum(c, len(shared) - 1)] == k) if len(shared) else np.zeros(len(k), bool)
    xm, ym = keep(xc, xk), keep(yc, yk)
    xr, xc, yr, yc = xr[xm], xc[xm], yr[ym], yc[ym]
    for lo in range(0, len(shared), COLUMNS):
        a, b = np.zeros((len(x), COLUMNS), np.float32), np.zeros((len(y), COLUMNS), np.float32)
        i, j = (xc >= lo) & (xc < lo + COLUMNS), (yc >= lo) & (yc < lo + COLUMNS)
        a[xr[i], xc[i] - lo] = 1
        b[yr[j], yc[j] - lo] = 1
        out += a @ b.T
    return np.rint(out).astype(np.int64)


def block_links(ids: np.ndarray, component: np.ndarray, second: np.ndarray, bags: list, same: bool, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between the block's two sides (``same``: among all) across components."""
    xs, ys = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
    if not len(xs) or not len(ys):
        return []
    size = np.array([w.sum() for _, w in bags])
    a, b = size[xs][:, None], size[ys][None, :]
    open_ = (component[xs][:, None] != component[ys][None, :]) & (np.minimum(a, b) >= least * np.maximum(a, b))
    if same:
        open_ = np.triu(open_, 1)
    if not open_.any():
        return []
    if open_.sum() <= 64:
        found = [(i, j) for i, j in zip(*np.nonzero(open_)) if similarity(bags[xs[i]], bags[ys[j]]) >= least]
    else:
        shared = block_overlaps([bags[i] for i in xs], [bags[j] for j in ys])
        found = list(zip(*np.nonzero(open_ & (shared >= least * (a + b - shared)))))
    parent = {}

    def root(c):
        while (up := parent.get(c, c)) != c:
            parent[c] = parent.get(up, up)
            c = up
        return c

    out = []
    for i, j in found:
        x, y = root(component[xs[i]]), root(component[ys[j]])
        if x != y:
            parent[x] = y
            out.append((int(ids[xs[i]]), int(ids[ys[j]])))
    return out


def _block_verified(blocks: DataFrame, words: int, least: float) -> DataFrame:
    """Links (a, b) found inside each (key, kind, s, t) block of rows (id, component, second, text)."""
    dealt = blocks.repartition("key", "kind", "s", "t").sortWithinPartitions("key", "kind", "s", "t")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def links():
            ids, component, second = (np.concatenate([h[i] for h in held]) for i in range(3))
            found = block_links(ids, component, second, [b for h in held for b in h[3]], key[1] == 0 and key[2] == key[3], least)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        for whole in batches:
            for batch in byte_slices(whole, "text", 2 << 20):
                keys, weights, sizes = bags(*shingles(*word_hashes(batch.column("text")), words))
                ends = np.cumsum(sizes)
                each = [(keys[e - n:e], weights[e - n:e]) for e, n in zip(ends, sizes)]
                at = [batch.column(c).to_numpy() for c in ("key", "kind", "s", "t")]
                change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in at], axis=0)) + 1
                ids, component = batch.column("id").to_numpy(), batch.column("component").to_numpy()
                second = batch.column("second").to_numpy(zero_copy_only=False)
                for lo, hi in zip([0, *change], [*change, batch.num_rows]):
                    now = tuple(int(c[lo]) for c in at)
                    if now != key:
                        if held:
                            yield from links()
                        key, held = now, []
                    held.append((ids[lo:hi], component[lo:hi], second[lo:hi], each[lo:hi]))
        if held:
            yield from links()

    return dealt.mapInArrow(compare, "a long, b long")


def _open_blocks(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to the block pairs that compare them."""
    placed = shared.join(known, F.col("id") == F.col("node"), "left").select("key", "id", "size", F.coalesce("component", "id").alias("component"))
    per = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    order = F.struct("n", (-F.col("component")).alias("c"))
    sums = per.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.max_by("component", order).alias("main"), F.max(order)["n"].alias("mn"), F.max_by("w", order).alias("mw")).where("parts > 1")
    count = lambda n, w: F.greatest(F.ceil(n / BLOCK_MEMBERS), F.ceil(w / BLOCK_SHINGLES)).cast("int")
    # a bucket that fits one block is compared as a whole, all members as loose ones
    whole = count(F.col("n"), F.col("w")) <= 1
    sums = sums.select("key", "main", F.when(whole, 1).otherwise(count(F.col("n") - F.col("mn"), F.col("w") - F.col("mw"))).alias("loose"),
                       F.when(whole, 0).otherwise(count(F.col("mn"), F.col("mw"))).alias("tied"))
    members = placed.join(sums, "key").withColumn("in_main", (F.col("component") == F.col("main")) & (F.col("tied") > 0))
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("in_main"), F.col("tied")).otherwise(F.col("loose"))).cast("int"))
    tile = lambda kind, s, t, second: F.struct(F.lit(kind).alias("kind"), s.cast("int").alias("s"), t.cast("int").alias("t"), second.alias("second"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    among = F.transform(upto("loose"), lambda i: tile(0, F.least(i, F.col("block")), F.greatest(i, F.col("block")), F.col("block") > i))
    against = F.transform(F.slice(upto("tied"), F.lit(1), F.col("tied")), lambda j: tile(1, F.col("block"), j, F.lit(False)))
    inside = F.transform(upto("loose"), lambda i: tile(1, i, F.col("block"), F.lit(True)))
    return members.select("key", "id", "component", F.explode(F.when(F.col("in_main"), inside).otherwise(F.concat(among, against))).alias("x")).select("key", "id", "component", "x.*")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, null_ids: bool = False) -> DataFrame:
    """(id, digest, n, class_id, rep_id, rep_digest) of every document with words: one row per id and text.

    ``n`` rows have this id and text, ``class_id`` is the smallest id with an equal text, and (``rep_id``,
    ``rep_digest``) is the representative of its component: of all texts reachable over links of similarity
    ``least`` or more the smallest (id, digest).
    """
    sig = signed(docs, id_col, text_col, words, bands, rows, null_ids)
    # one node per text, numbered in the order of the smallest ids; once, in a table that is written
    classes = stored(sig.groupBy("digest").agg(F.min("id").alias("class_id")).orderBy("class_id", "digest").withColumn("node", F.monotonically_increasing_id()), "classes")
    # a class stands in the buckets with one row: its smallest id's
    firsts = classes.select(F.col("class_id").alias("id"), "digest", "node")
    stand = sig.join(firsts, ["id", "digest"]).select(F.col("node").alias("id"), "size", F.explode("keys").alias("key")).distinct()
    buckets = stand.groupBy("key").agg(F.min(F.struct("id", "size")).alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = stored(stand.join(buckets, "key"), "buckets")
    close = F.least("size", "pivot.size") >= least * F.greatest("size", "pivot.size")
    star = shared.where((F.col("id") != F.col("pivot.id")) & close).select(F.col("pivot.id").alias("a"), F.col("id").alias("b")).distinct()
    wanted = firsts.join(shared.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    texts = stored(docs.select(*_keyed(id_col, text_col, null_ids), F.col(text_col).cast("string").alias("text")).join(wanted, ["id", "digest"]).select(F.col("node").alias("id"), "text").distinct(), "candidate-texts")
    first = stored(_verified(star, texts, words, least), "first-links")
    opened = _open_blocks(shared.select("key", "id", "size"), components(first)).join(texts, "id")
    second = stored(_block_verified(opened, words, least), "second-links")
    linked = components(first.union(second)).join(classes, "node")
    best = linked.groupBy("component").agg(F.min(F.struct("class_id", "digest")).alias("rep"))
    ranked = classes.join(linked.select("node", "component").join(best, "component").select("node", "rep"), "node", "left")
    ranked = ranked.select("digest", "class_id", F.coalesce("rep.class_id", "class_id").alias("rep_id"), F.coalesce("rep.digest", "digest").alias("rep_digest"))
    return sig.groupBy("id", "digest").agg(F.count("*").alias("n")).join(ranked, "digest").select("id", "digest", "n", "class_id", "rep_id", "rep_digest")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per document id: the smallest class and component of its texts, and whether a row of it stays."""
    here = (F.col("id") == F.col("rep_id")) & (F.col("digest") == F.col("rep_digest"))
    found = near_duplicates(docs).groupBy(F.col("id").alias("doc_id")).agg(F.min("class_id").alias("class_id"), F.min("rep_id").alias("component_id"), F.max(here).alias("kept"))
    # an id with a text without words keeps that row
    blank = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD)
    return (docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(blank).alias("blank")).join(found, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    (F.col("blank") | F.coalesce("kept", F.lit(True))).alias("kept")))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, and rows without words; columns as they were.  A null id counts as the largest."""
    found = near_duplicates(docs, id_col, text_col, null_ids=True)
    here = (F.col("id") == F.col("rep_id")) & (F.col("digest") == F.col("rep_digest"))
    # single rows that represent themselves need no partner
    fate = found.select("id", "digest", here.alias("stays"), "n").where("NOT stays OR n > 1").drop("n")
    rows = docs.select(*_keyed(id_col, text_col, True), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    # one join carries the fate, at every size the same one; what is left is written once and read for both halves
    met = rows.join(stored(fate, "fates").hint("merge"), ["id", "digest"], "left").where("stays IS NULL OR stays")
    met = stored(met.withColumn("again", F.col("stays").isNotNull()).drop("stays"), "representatives")
    # of repeated rows one stays, the smallest by its other columns (maps have no order); the texts are equal
    order = [F.col(f"doc.`{f.name}`") for f in docs.schema.fields if f.name != text_col and "map<" not in f.dataType.simpleString()]
    # a hot pair's rows meet pre-aggregated
    repeated = met.where("again").groupBy("id", "digest").agg(F.min_by("doc", F.struct(*order)).alias("doc"))
    return met.where("NOT again").select("doc.*").unionByName(repeated.select("doc.*"))
