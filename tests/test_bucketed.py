"""Bucketed tables: no exchange on the cold part, hot keys apart, the layout reopened by path."""

import collections
import uuid

import pytest

from vireo.operators import clean
from vireo.plans import load_all
from vireo.plans.registry import ORACLE, QUERIES
from vireo.session import scratch_dir
from vireo.sources import bucketed
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def laid(spark):
    """Key 0 holds a third of the rows, the null key another large part."""
    rows = [(0, i, f"t{i % 3}") for i in range(400)] + [(None, i, "n") for i in range(300)] + [(1 + i % 90, i, f"t{i}") for i in range(500)]
    left = spark.createDataFrame(rows, "k long, v long, t string")
    right = spark.createDataFrame([(k, f"name{k}") for k in (None, *range(0, 120))] + [(5, "again")], "k long, name string")
    path = scratch_dir(spark, f"bucketed-{uuid.uuid4().hex}")
    return path, left, right, bucketed.write_bucketed({"left": left, "right": right}, path, ["k"], rows_per_bucket=100)


def test_layout(spark, laid):
    _, left, right, tables = laid
    assert tables["left"].buckets == tables["right"].buckets == 12
    assert sorted(str(r["k"]) for r in tables["left"].hot.select("k").distinct().collect()) == ["0", "None"]
    for name, df in (("left", left), ("right", right)):
        assert sorted(map(str, tables[name].rows().collect())) == sorted(map(str, df.collect()))


def test_keyed_work_needs_no_exchange(spark, laid):
    _, left, right, tables = laid
    want = collections.Counter(r["k"] for r in left.collect())
    sizes = bucketed.group_sizes(tables["left"])
    assert {r["k"]: r["n"] for r in sizes.collect()} == want and sizes.count() == len(want)
    cold = bucketed.Bucketed(tables["left"].cold, tables["left"].cold.limit(0), ["k"], 12)
    assert "Exchange" not in plan(tables["left"].cold.groupBy("k").count())
    assert plan(bucketed.first_rows(cold, "v")).count("Exchange") <= 2  # of the empty hot part
    joined = tables["left"].cold.hint("merge").join(tables["right"].cold, ["k"])
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)


def test_results_equal_the_plain_operators(spark, laid):
    _, left, right, tables = laid
    assert sorted(map(str, bucketed.first_rows(tables["left"], "v").collect())) == sorted(map(str, clean.dedup(left, ["k"], "v").collect()))
    for how in ("inner", "left", "full"):
        got = bucketed.join_bucketed(tables["left"], tables["right"], how)
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, ["k"], how).collect()))


def test_reopened_by_path(spark, laid):
    path, left, _, _ = laid
    again = bucketed.open_bucketed(spark.newSession(), path)["left"]
    assert again.buckets == 12 and "Exchange" not in plan(again.cold.groupBy("k").count())
    assert again.rows().count() == left.count()


def test_empty_and_mismatched(spark, laid):
    empty = spark.createDataFrame([], "k long, v long")
    t = bucketed.write_bucketed({"t": empty}, scratch_dir(spark, f"bucketed-{uuid.uuid4().hex}"), ["k"])["t"]
    assert t.buckets == 1 and bucketed.group_sizes(t).count() == 0 and bucketed.first_rows(t, "v").count() == 0
    with pytest.raises(ValueError):
        bucketed.join_bucketed(t, laid[3]["left"])


@pytest.mark.parametrize("name", ["bucketed_dedup", "bucketed_join", "bucketed_orders", "bucketed_groups"])
def test_queries_equal_sql(spark, duck, name):
    load_all()
    df, rel = QUERIES[name](spark, SF_SMALL), duck(SF_SMALL).sql(ORACLE[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == want
