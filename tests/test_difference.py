"""Table difference against a plain count of rows."""

import collections
import random

from vireo.operators import difference

SCHEMA = "k1 long, k2 string, score double, note string"


def _plain(a, b):
    by = collections.defaultdict(lambda: (collections.Counter(), collections.Counter()))
    for side, rows in enumerate((a, b)):
        for r in rows:
            by[r[:2]][side][r[2:]] += 1
    out = set()
    for k, (x, y) in by.items():
        if x != y:
            out.add((*k, "added" if not x else "removed" if not y else "changed", sum(x.values()), sum(y.values())))
    return out


def test_equals_a_plain_count(spark):
    rng = random.Random(5)
    pick = lambda: (rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, "", "a", "b|", "b"]), rng.choice([None, 0.5, 0.25]), rng.choice([None, "", "-"]))
    a, b = [pick() for _ in range(60)], [pick() for _ in range(60)]
    b += a[:20]
    rng.shuffle(b)
    for ranges in (1, 3, 4096):
        got = difference.table_difference(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k1", "k2"], ranges=ranges)
        assert {tuple(r) for r in got.collect()} == _plain(a, b)


def test_repeated_rows_count_and_order_does_not(spark):
    a = [(1, "x", 0.5, "n"), (1, "x", 0.5, "n"), (2, "y", 1.0, "p"), (2, "y", 2.0, "q")]
    b = [(2, "y", 2.0, "q"), (1, "x", 0.5, "n"), (2, "y", 1.0, "p")]
    got = difference.table_difference(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k1", "k2"])
    assert [tuple(r) for r in got.collect()] == [(1, "x", "changed", 2, 1)]


def test_empty_and_equal_tables(spark):
    some, none = spark.createDataFrame([(1, "x", 0.5, "n")], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert difference.table_difference(some, some, ["k1", "k2"]).count() == 0
    assert difference.table_difference(none, none, ["k1", "k2"]).count() == 0
    assert [r["status"] for r in difference.table_difference(none, some, ["k1", "k2"]).collect()] == ["added"]


def test_only_differing_ranges_are_compared(spark):
    a = spark.range(5000).selectExpr("id AS k1", "'x' AS k2", "id * 0.5D AS score", "'n' AS note")
    b = a.selectExpr("k1", "k2", "IF(k1 = 77, -1D, score) AS score", "note")
    da, db = (difference._digested(t, ["k1", "k2"], ["score", "note"], 512) for t in (a, b))
    assert difference.differing_ranges(da, db).count() == 1
    plan = difference.table_difference(a, b, ["k1", "k2"], ranges=512)
    assert [tuple(r) for r in plan.collect()] == [(77, "x", "changed", 1, 1)]
    assert "CartesianProduct" not in plan._jdf.queryExecution().toString()
