"""Operator 12 against brute force."""

import math

import numpy as np
import pytest

from tests.conftest import SF_CHECK
from tests.llm import data
from vireo.llm import hard_negatives as hn
from vireo.llm import queries

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return data.frame(spark, [(i, v, label, *["x"] * 4) for i, v, label in rows], data.VECTORS)


def brute(rows, band=(30, 90), positives=5, negatives=10):
    known = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        x = (tuple(float(np.float32(c)) for c in v), label)
        known[i] = min(known[i], x) if i in known else x
    codes = {i: [math.floor(256 * c) for c in v] for i, (v, _) in known.items()}
    out = set()
    for a in known:
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(codes[a], codes[i])), i) for i in known if i != a and len(codes[i]) == len(codes[a]))
        same = [(i, -s) for s, i in scores if known[i][1] == known[a][1]][:positives]
        for p, ps in same:
            fits = [(i, -s) for s, i in scores if known[i][1] != known[a][1] and band[0] * ps <= -100 * s <= band[1] * ps][:negatives]
            out |= {(a, p, r, i, ps, s) for r, (i, s) in enumerate(fits, 1)}
    return out


def edge_rows():
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((4, 20))
    rows = [(i, (centre[i % 4] + 0.4 * rng.standard_normal(20)).tolist(), int(rng.integers(0, 5))) for i in range(700)]
    rows += [(1000 + i, rows[0][1], int(i % 3)) for i in range(150)]  # one common vector, many ties
    rows += [(2000 + i, rng.standard_normal(3).tolist(), 1) for i in range(40)] + [(2100, [1e6, -3.5, 0.25], 1), (2200, [0.0] * 3, 1), (2300, [-1.0, -1.0, 2.0], 2)]
    rows += [(300, None, 1), (400, rows[400][1], None), (5000, [NAN] * 20, 1), (5100, [INF, *[1.0] * 19], 1), (5200, [None, *[1.0] * 19], 1), (5300, [], 1), (None, [1.0] * 20, 1)]
    rows += [(500, rows[3][1], 2), (500, rows[500][1], 4), (100, rows[100][1], rows[100][2]), (6000, [0.0] * 20, 3), (6100, [-0.5] * 20, 7)]
    return rows


@pytest.mark.parametrize("base,anchors", [(4096, 2048), (60, 3)])
def test_hard_negatives_equal_brute_force(spark, base, anchors):
    rows = edge_rows()
    got = [tuple(r) for r in hn.hard_negatives(hn.shifted_labels(frame(spark, rows)), base_rows=base, anchor_rows=anchors).collect()]
    assert len(got) == len(set(got)) > 50
    assert set(got) == brute(rows)


def test_hard_negatives_of_the_table_equal_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.QUERIES["op12_segment_hard_negatives"](spark, SF_CHECK).collect()} == brute(rows)


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(100, None, 1)], [(100, [1.0], 1), (200, [1.0], 2)]):  # the last: no other row of the label
        assert hn.hard_negatives(hn.shifted_labels(frame(spark, rows))).count() == 0


def block(x, label=0):
    codes = np.floor(hn.SCALE * x).astype(np.int32)
    mean, deviation = hn.summaries(codes)
    n = len(x)
    return hn.Block(np.arange(n).tobytes(), np.full(n, label).tobytes(), codes.tobytes(), mean.tobytes(), deviation.tobytes(), x.shape[1])


@pytest.mark.parametrize("dimension", [1, 3, 7, 64, 100, 768])
def test_bounds_hold_and_tighten_on_every_level(dimension):
    rng = np.random.default_rng(dimension)
    q, b = block(rng.standard_normal((30, dimension))), block(np.cumsum(rng.standard_normal((40, dimension)), axis=1))
    true = q.codes.astype(np.int64) @ b.codes.T.astype(np.int64)
    widths = []
    for (mean, deviation), (mean2, deviation2) in zip(q.levels, b.levels):
        near, slack = mean @ mean2.T, deviation @ deviation2.T
        assert (np.abs(true - near) <= slack + 1e-6 * np.abs(near) + 1e-6).all()
        widths.append(slack.mean())
    assert len(widths) == len(hn.level_counts(dimension)) and all(a >= b - 1e-9 for a, b in zip(widths, widths[1:]))


def test_levels_remove_most_pairs_of_smooth_vectors():
    """Where neighbouring components go together, few pairs reach exact scoring, and none that matters is lost."""
    rng = np.random.default_rng(9)
    q, b = (block(np.repeat(rng.standard_normal((n, 16)), 4, axis=1) + 0.02 * rng.standard_normal((n, 64))) for n in (50, 2000))
    f, rows, cols = hn.Filter(len(q.levels)), np.arange(50), np.arange(2000)
    i, j = f.passing(q, rows, b, cols, np.ones((50, 2000), bool), np.full(50, -np.inf), None, 10)
    assert len(i) < 0.02 * 50 * 2000
    true = q.codes.astype(np.int64) @ b.codes.T.astype(np.int64)
    kept = set(zip(i.tolist(), j.tolist()))
    assert all((a, c) in kept for a in range(50) for c in np.argsort(-true[a])[:10].tolist())


def test_scores_beyond_float_precision_are_exact():
    x = np.full((2, 4), 400_000.0)
    x[1, 0] -= 1 / 256
    b = block(x)
    i = np.array([0, 0, 1, 1])
    got = hn.scored(b, np.arange(2), b, np.arange(2), i, i[[0, 2, 0, 2]])
    whole = [[int(c) for c in r] for r in b.codes]
    assert got.tolist() == [sum(p * q for p, q in zip(whole[a], whole[c])) for a, c in ((0, 0), (0, 1), (1, 0), (1, 1))]
