"""Operator 13 against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.conftest import SF_CHECK
from tests.llm import data
from vireo.llm import prefix_trie, queries
from vireo.llm.prefix_trie import ZFastTrie, conversation_trie, ordered_turns, plain, rebuilt, two_fattest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                      # names that the operator uses inside
                      *[T.StructField(c, T.StringType()) for c in ("conv", "at", "range", "n", "words", "depth", "chunk", "part", "sha")]])


def sequences(rows):
    """Turns (role, text) of every conversation; equal turn numbers by digest."""
    conv = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            conv[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], role, text))
    return {c: tuple(x[2:] for x in sorted(v, key=lambda x: x[:2])) for c, v in conv.items()}


def rebuild(seq):
    out = {}
    for c, own in seq.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seq.get(c - int(math.fmod(c, 20)), ())[:h] + own[h:]
    return out


def nodes(strings):
    members, ends = collections.defaultdict(set), collections.defaultdict(list)
    for c, s in strings.items():
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
        ends[s].append(c)
    kids = collections.Counter(s[:-1] for s in members if s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, m in members.items():
        words = len(WORD.findall(s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += kids[s] == 0
            saved[s[:d]] += (len(m) - 1) * words
    return sorted(((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())
                   for s, m in members.items()), key=lambda r: r[:2])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[:2])


def edge_turns():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b c", "", None, "x\ty\nz", "hot turn"])) for c in range(60) for t in range(rng.randrange(8))]
    rows += [(c, t, "user", "same start") for c in range(100, 400, 3) for t in range(2)]  # one common conversation
    rows += [(500, t, "user", f"turn {t % 7}") for t in range(150)]  # a long one, and its block
    rows += [(501, t, "user", f"turn {t % 7}") for t in range(90)]
    rows += [(700, None, "user", "first"), (700, None, "user", "first too"), (700, 5, "a", "b"), (700, 5, "a", "b"), (700, 5, "a", "b")]
    rows += [(-3, 0, "u", "negative"), (-40, 1, "u", "negative"), (None, 1, "u", "nobody"), (None, None, None, None), (801, 0, "u", "only one"), (9, 0, "u", "w " * 5000)]
    return rows


def frame(spark, rows):
    return data.frame(spark, [(*r, *["x"] * 9) for r in rows], TURNS)


@pytest.mark.parametrize("chunk,part", [(4096, 100_000), (4, 60), (1, 1000)])
def test_rebuilt_trie_equals_brute_force(spark, chunk, part):
    rows = edge_turns()
    got = rows_of(conversation_trie(*rebuilt(ordered_turns(frame(spark, rows))), chunk=chunk, part_turns=part))
    assert got == nodes(rebuild(sequences(rows)))


def test_plain_trie_equals_brute_force(spark):
    rows = edge_turns()
    assert rows_of(conversation_trie(*plain(ordered_turns(frame(spark, rows))), part_turns=200)) == nodes(sequences(rows))


def test_trie_of_the_table_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.QUERIES["op13_z_fast_trie"](spark, SF_CHECK)) == nodes(rebuild(sequences(rows)))


def test_trie_of_nothing(spark):
    assert prefix_trie.rebuilt_conversation_trie(frame(spark, [])).count() == 0
    assert prefix_trie.rebuilt_conversation_trie(frame(spark, [(None, 1, "u", "x")])).count() == 0
    only = rows_of(prefix_trie.rebuilt_conversation_trie(frame(spark, [(801, 0, "u", "x")])))  # its base is absent, its turns are taken away
    assert only == nodes(rebuild(sequences([(801, 0, "u", "x")])))


def test_two_fattest_numbers():
    for low in range(40):
        for high in range(low + 1, 60):
            best = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert two_fattest(low, high) == best


def test_fat_binary_search_finds_the_exit_node():
    """Each string's agreement with the trie, and every handle, equal a plain search over all strings."""
    rng = np.random.default_rng(5)

    def string(symbols):
        keys = np.bitwise_xor.accumulate(np.array([[hash((i, s)), hash((s, i, 1))] for i, s in enumerate(symbols)], dtype=np.int64).reshape(-1, 2), axis=0)
        return keys.tobytes()

    known = [tuple(rng.integers(0, 2, rng.integers(0, 40)).tolist()) for _ in range(300)]
    trie = ZFastTrie()
    for i in range(0, len(known), 50):
        trie.insert_batch([(string(s), np.zeros(len(s), np.int64), j) for j, s in enumerate(known[i:i + 50], i)])
    prefixes = {s[:d] for s in known for d in range(len(s) + 1)}
    for s in known + [tuple(rng.integers(0, 2, rng.integers(0, 50)).tolist()) for _ in range(300)]:
        node, depth = trie.locate(string(s))
        assert depth == max(d for d in range(len(s) + 1) if s[:d] in prefixes)
        assert trie.start[node] - 1 <= depth <= trie.end[node]
    for key, node in trie.handle.items():
        f = two_fattest(trie.start[node] - 1, trie.end[node])
        assert key == trie.rep[node][16 * (f - 1):16 * f]
    assert len(trie.handle) == len(trie.start) - 1
