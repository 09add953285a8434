"""Activity threshold and label, including the tie fixture and the salted join."""

from pyspark.sql import functions as F

from vireo.operators import label


def _groups(spark, sizes):
    rows = [(f"g{i}",) for i, n in enumerate(sizes) for _ in range(n)]
    return spark.createDataFrame(rows, "grp string")


def test_labels_are_binary(spark):
    df = _groups(spark, range(1, 101))            # sub_0..sub_99 with i+1 rows
    out = label.activity_label(df, "grp")
    assert {r[0] for r in out.select("is_active").distinct().collect()} <= {0, 1}
    assert out.count() == 5050


def test_tie_fixture_element_vs_linear(spark):
    df = _groups(spark, [100] * 5 + [10] * 20)
    e = label.activity_threshold(df, "grp", 0.8, "element").first()[0]
    lin = label.activity_threshold(df, "grp", 0.8, "linear").first()[0]
    assert e == 10.0
    assert lin == 28.0
    share_e = label.activity_label(df, "grp", method="element").agg(F.avg("is_active")).first()[0]
    share_l = label.activity_label(df, "grp", method="linear").agg(F.avg("is_active")).first()[0]
    assert share_e == 1.0
    assert abs(share_l - 500 / 700) < 1e-12


def test_null_group_gets_zero(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "grp string")
    out = {(r["grp"], r["is_active"]) for r in label.activity_label(df, "grp").collect()}
    assert (None, 0) in out


def test_salted_path_equals_broadcast_path(spark):
    df = _groups(spark, [300, 5, 5, 7, 1, 2, 3, 50])
    a = label.activity_label(df, "grp").groupBy("grp", "is_active").count()
    b = label.activity_label(df, "grp", max_broadcast_bytes=0).groupBy("grp", "is_active").count()
    assert sorted(a.collect()) == sorted(b.collect())


def test_broadcast_in_plan(spark):
    df = _groups(spark, [3, 2, 1])
    plan = label.activity_label(df, "grp")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_hot_key_salting_equals_broadcast(spark):
    from vireo.operators.joins import join_group_table
    df = _groups(spark, [400, 5, 5, 7, 1, 2, 3, 50])
    sizes = label.group_sizes(df, "grp")
    a = join_group_table(df, sizes, ["grp"], "left")
    b = join_group_table(df, sizes, ["grp"], "left", max_broadcast_bytes=0, size_col="n", hot_rows=40)
    c = join_group_table(df, sizes, ["grp"], "left", max_broadcast_bytes=0, size_col="n")
    want = sorted(a.groupBy("grp", "n").count().collect())
    assert sorted(b.groupBy("grp", "n").count().collect()) == want
    assert sorted(c.groupBy("grp", "n").count().collect()) == want
    assert b.count() == df.count()


def test_keep_size_column(spark):
    df = _groups(spark, [3, 1])
    out = label.activity_label(df, "grp", keep_size=True)
    assert "n" in out.columns and "__size" not in out.columns
    assert "__size" not in label.activity_label(df, "grp").columns
