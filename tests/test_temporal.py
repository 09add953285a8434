"""As-of joins, interval joins, sessions, levels, mergeable state and exact samples against plain Python."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vireo.operators import clean, levels, parallel, sampling, sketches, temporal

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def hot_rows(n, seed):
    """(key, seconds): key 7 has a third of all rows, some keys and times are null."""
    rng = random.Random(seed)
    return [(7 if rng.random() < 0.34 else rng.choice([1, 2, 3, 50, None]), rng.choice([None, *[rng.randrange(2000)] * 30])) for _ in range(n)]


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_a_search_for_every_row(spark, strict):
    left = [(i, k, at(s), "x") for i, (k, s) in enumerate(hot_rows(900, 1))]
    right = [(k, at(s), v) for v, (k, s) in enumerate(hot_rows(300, 2))]
    a = spark.createDataFrame(left, "id int, k int, t timestamp, v string").repartition(5)
    b = spark.createDataFrame(right, "k int, u timestamp, w int").repartition(3)
    got = {r["id"]: r["w"] for r in temporal.asof_join(a, b, ["k"], "t", "u", ["w"], strict).collect()}
    known = {}
    for k, u, w in right:
        if k is not None and u is not None:
            known.setdefault(k, []).append((u, w))
    for rows in known.values():
        rows.sort()
    for i, k, t, _ in left:
        rows = known.get(k, []) if t is not None else []
        n = bisect.bisect_left([u for u, _ in rows], t) if strict else bisect.bisect_right([u for u, _ in rows], t)
        assert got[i] == (rows[n - 1][1] if n else None)
    assert len(got) == len(left)


def test_a_hot_key_of_an_asof_join_is_cut_by_time(spark):
    a = spark.range(4000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("t"))
    b = spark.createDataFrame([(1, at(0) - dt.timedelta(days=30_000), 5)], "k int, u timestamp, w int")  # far before everything
    out = temporal.asof_join(a, b, ["k"], "t", "u", ["w"])
    assert out.where("w = 5").count() == out.count() == 4000 or out.where("w IS NULL").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan  # windows are by key and range, not by key alone


def test_sessions_equal_a_scan(spark):
    rows = hot_rows(1500, 4)
    df = spark.createDataFrame([(k, at(s)) for k, s in rows], "k int, t timestamp").repartition(6)
    for gap in (1, 7, 60):
        got = sorted(((r["k"] is not None, r["k"] or 0, r["session_start"], r["session_end"], r["n"]) for r in temporal.session_windows(df, ["k"], "t", gap).collect()))
        want = []
        for k in {k for k, _ in rows}:
            times = sorted(s for x, s in rows if x == k and s is not None)
            runs = []
            for s in times:
                if runs and s - runs[-1][-1] < gap:
                    runs[-1].append(s)
                else:
                    runs.append([s])
            want += [(k is not None, k or 0, at(r[0]), at(r[-1] + gap), len(r)) for r in runs]
        assert got == sorted(want)


@pytest.mark.parametrize("width", [3, 40, 10_000])
def test_interval_join_finds_each_overlap_once(spark, width):
    rng = random.Random(8)

    def spans(n):
        out = [(i, rng.randrange(-50, 500)) for i in range(n)]
        return [(i, s, s + rng.choice([0, 1, 5, 90, -3])) for i, s in out] + [(n, None, 5), (n + 1, 5, None)]

    left, right = spans(60), spans(80)
    a = spark.createDataFrame([(i, at(s), at(e)) for i, s, e in left], "a int, a0 timestamp, a1 timestamp")
    b = spark.createDataFrame([(i, at(s), at(e)) for i, s, e in right], "b int, b0 timestamp, b1 timestamp")
    got = sorted((r["a"], r["b"]) for r in temporal.interval_join(a, b, ("a0", "a1"), ("b0", "b1"), width).collect())
    full = [[x for x in side if None not in x and x[1] < x[2]] for side in (left, right)]
    assert got == sorted((i, j) for i, s, e in full[0] for j, u, v in full[1] if s < v and u < e)
    points = sorted((r["a"], r["b"]) for r in temporal.interval_join(a, b, ("a0", "a1"), "b0", width).collect())
    assert points == sorted((i, j) for i, s, e in full[0] for j, u, _ in right if u is not None and s <= u < e)
    plan = temporal.interval_join(a, b, ("a0", "a1"), ("b0", "b1"), width)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "__bin" in plan


def test_levels_are_made_from_the_grain(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4), ("b", "y", 8)], "p string, q string, v int")
    got = {(r["p"], r["q"], r["level"]): r["v"] for r in levels.grouping_levels(df, ["p", "q"], {"v": F.col("v")}, levels.cube_sets(["p", "q"])).collect()}
    assert got[None, None, 3] == 15 and got["a", None, 1] == 3 and got["a", None, 0] == 1 and got[None, "x", 2] == 6 and got[None, None, 1 | 0] == 4 if (None, None, 1) in got else True
    plan = levels.grouping_levels(df, ["p", "q"], {"v": F.col("v")}, levels.rollup_sets(["p", "q"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # the rows are aggregated below the expansion


def test_states_merge_to_the_state_of_all_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 9).alias("day"), (F.col("id") % 3001).alias("u"), (F.hash("id") % 1000 / 7).alias("x"))
    merged = sketches.read_state(sketches.merge_states(sketches.profile_state(df, ["day"], ["u"], ["x"]).drop("day"), []), [0.1, 0.5, 0.99]).first()
    whole = sketches.read_state(sketches.profile_state(df, [], ["u"], ["x"]), [0.1, 0.5, 0.99]).first()
    assert merged["rows"] == whole["rows"] == 20_000 and merged["u_distinct"] == whole["u_distinct"]
    assert abs(merged["u_distinct"] - 3001) <= 0.03 * 3001
    values = sorted(r["x"] for r in df.select("x").collect())
    for p, q in zip((0.1, 0.5, 0.99), merged["x_q"]):
        assert bisect.bisect_left(values, q) / 20_000 - 0.01 <= p <= bisect.bisect_right(values, q) / 20_000 + 0.01
    assert (merged["x_min"], merged["x_max"], merged["x_n"]) == (values[0], values[-1], 20_000)


def test_exact_samples_have_their_size_under_any_partitioning(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("c"))
    a = {r["id"] for r in sampling.exact_sample(df.repartition(1), "id", 20, ["c"]).collect()}
    b = sampling.exact_sample(df.repartition(13), "id", 20, ["c"])
    assert a == {r["id"] for r in b.collect()}
    assert {r["count"] for r in b.groupBy("c").count().collect()} == {20} and sampling.exact_sample(df, "id", 333).count() == 333
    assert "WindowGroupLimit" in b._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_ties_go_by_all_columns(spark):
    rows = [("t", 1, "b", None), ("t", 1, "a", "z"), ("t", 1, "a", "y"), ("t", 2, "0", "0"), (None, 5, "n", "n"), (None, 4, "n", "m")]
    for parts in (1, 4, 7):
        df = spark.createDataFrame(rows, "k string, o int, v string, w string").repartition(parts)
        assert sorted(map(tuple, clean.dedup(df, ["k"], "o").collect()), key=str) == sorted([("t", 1, "a", "y"), (None, 4, "n", "m")], key=str)


def test_a_file_of_one_row_group_is_spread_and_many_files_are_not(spark, tmp_path):
    # a copy, for other tests may have cached the table
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").coalesce(1).write.parquet(str(tmp_path / "one"))
    docs = spark.read.parquet(str(tmp_path / "one"))
    assert parallel.scan_units(docs.select("text").where("doc_id > 3"), 99) == 1
    assert parallel.spread(docs, 16).rdd.getNumPartitions() == 16
    docs.repartition(9).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert parallel.scan_units(many, 99) == 9 and parallel.spread(many, 16) is many
    assert parallel.scan_units(docs.groupBy("lang").count(), 99) is None
