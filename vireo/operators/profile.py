"""Profiling and data-quality operators (one aggregate pass each).

Every profile is a single ``agg`` over the table followed by an ``unpivot``
of the one-row result, instead of the reference's one job per column.
Results that are shares or means are rounded to 6 dp so they compare
exactly with an SQL oracle that sums in a different order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.functions.rows import rows_from
from vireo.operators.clean import key_digest
from vireo.operators.cumulative import exact_quantiles, row_numbers
from vireo.operators.joins import join_group_table, materialize
from vireo.operators.label import activity_threshold, group_activity

ROUND = 6
MAX_CLASSES = 1000


def _blank_or_null(c: str, dtype: T.DataType) -> Column:
    col = F.col(c)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return col.isNull() | (F.trim(col) == "")
    return col.isNull() | (F.trim(col.cast("string")) == "")


def _long_from_row(row_df: DataFrame, names: list[str], var: str, val: str) -> DataFrame:
    return row_df.unpivot([], names, var, val)


def schema_check(df: DataFrame, expected: list[str]) -> DataFrame:
    """B1: ``(column, status)`` -- 'missing' for expected names absent from
    ``df``, 'extra' for names of ``df`` not expected.  Names only."""
    spark = df.sparkSession
    actual = spark.createDataFrame([(c,) for c in df.columns], "column string")
    want = spark.createDataFrame([(c,) for c in expected], "column string")
    missing = want.join(actual, "column", "left_anti").withColumn("status", F.lit("missing"))
    extra = actual.join(want, "column", "left_anti").withColumn("status", F.lit("extra"))
    return missing.unionByName(extra)


def missing_profile(df: DataFrame) -> DataFrame:
    """B2: null-or-blank count and percentage per column, one pass, by pct desc."""
    fields = df.schema.fields
    aggs = [F.count_if(_blank_or_null(f.name, f.dataType)).alias(f.name) for f in fields]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    long = row.unpivot(["__rows"], [f.name for f in fields], "column", "missing")
    return (long.select("column", "missing",
                        F.round(F.when(F.col("__rows") > 0, F.col("missing") * 100.0 / F.col("__rows"))
                                .otherwise(0.0), ROUND).alias("pct"))
                .orderBy(F.desc("pct"), "column"))


def null_profile(df: DataFrame, warn_pct: float = 5.0) -> DataFrame:
    """Null-only count, pct and status ('OK' below ``warn_pct``, else 'WARN')."""
    names = df.columns
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in names]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    long = row.unpivot(["__rows"], names, "column", "nulls")
    pct = F.when(F.col("__rows") > 0, F.col("nulls") * 100.0 / F.col("__rows")).otherwise(0.0)
    return long.select("column", F.col("nulls").cast("bigint").alias("nulls"),
                       F.round(pct, ROUND).alias("pct"),
                       F.when(pct < warn_pct, "OK").otherwise("WARN").alias("status"))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (a null key counts once) and duplicates.

    Distinct keys are counted by a 256-bit digest, so long texts are not shuffled; the
    count is a two-level aggregate, so a hot key is pre-reduced on the map side.
    """
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key_digest([key])).alias("distinct_keys"))
    return agg.select(F.col("rows").cast("bigint").alias("rows"), F.col("distinct_keys").cast("bigint").alias("distinct_keys"),
                      (F.col("rows") - F.col("distinct_keys")).cast("bigint").alias("duplicates"))


def dataset_overview(df: DataFrame, group: str, q: float = 0.8, method: str = "element") -> DataFrame:
    """``(metric, value)`` -- rows, columns, groups, threshold, active and
    inactive groups, positive and negative rows.  Everything is computed."""
    groups = group_activity(df, group, q, method)
    g = groups.agg(F.count(F.lit(1)).alias("groups"),
                   F.sum("is_active").alias("active_groups"),
                   F.sum(F.when(F.col("is_active") == 1, F.col("n")).otherwise(0)).alias("positive_rows"))
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    thr = activity_threshold(df, group, q, method).scalar()
    wide = g.select(
        rows.cast("double").alias("rows"),
        F.lit(float(len(df.columns))).alias("columns"),
        F.col("groups").cast("double").alias("groups"),
        thr.cast("double").alias("threshold"),
        F.col("active_groups").cast("double").alias("active_groups"),
        (F.col("groups") - F.col("active_groups")).cast("double").alias("inactive_groups"),
        F.col("positive_rows").cast("double").alias("positive_rows"),
        (rows - F.col("positive_rows")).cast("double").alias("negative_rows"),
    )
    names = ["rows", "columns", "groups", "threshold", "active_groups", "inactive_groups",
             "positive_rows", "negative_rows"]
    return _long_from_row(wide, names, "metric", "value")


def describe_numeric(df: DataFrame, cols: list[str], quartiles: bool = True,
                     accuracy: int = 10_000, method: str = "element") -> DataFrame:
    """``(column, count, mean, stddev, min, max[, q1, median, q3])``.

    Quartiles are exact at any size: ``method='element'`` gives the smallest value whose cumulative
    share reaches the quartile, ``'linear'`` interpolates like pandas' describe; both rank distinct values over
    range partitions (``cumulative.exact_quantiles``).  ``'sketch'`` is ``percentile_approx`` with relative
    rank error 1 / ``accuracy``, for one pass over huge continuous columns.
    """
    if method not in ("element", "linear", "sketch"):
        raise ValueError(f"unknown quartile method {method!r}")
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if quartiles and method == "sketch":
            aggs.append(F.percentile_approx(x, probs, accuracy).alias(f"{c}__q"))
    rows = []
    for c in cols:
        r = {"column": F.lit(c), "count": F.col(f"{c}__count").cast("bigint"),
             "mean": F.round(f"{c}__mean", ROUND), "stddev": F.round(f"{c}__stddev", ROUND),
             "min": F.col(f"{c}__min"), "max": F.col(f"{c}__max")}
        if quartiles and method == "sketch":
            r["q"] = F.col(f"{c}__q")
        rows.append(r)
    out = rows_from(df.agg(*aggs), rows)
    if not quartiles:
        return out
    if method != "sketch":
        values = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "__col", "__v")
        q = exact_quantiles(values, "__v", probs, ["__col"], linear=method == "linear").select("__col", "q")
        out = out.join(q, F.col("column") == F.col("__col"), "left").drop("__col")
    return out.select(*[c for c in out.columns if c != "q"], *[F.col("q")[i].alias(n) for i, n in enumerate(["q1", "median", "q3"])])


def group_distribution(df: DataFrame, group: str, k: int | None = 30) -> DataFrame:
    """``(group, n, rank, total_groups)`` by count desc, name asc; top ``k``.

    ``orderBy(...).limit(k)`` plans as a distributed top-k
    (TakeOrderedAndProject): each task keeps k rows, the driver merges them.
    Without ``k`` all groups are ranked over range partitions.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    orders = [F.desc("n"), F.asc_nulls_last(group)]
    if k is None:
        sizes = materialize(sizes)
        total = sizes.agg(F.count(F.lit(1))).scalar()
        ranked = row_numbers(sizes, orders, "rank")
        return ranked.select(group, "n", F.col("rank").cast("int").alias("rank"), total.alias("total_groups"))
    total = sizes.agg(F.count(F.lit(1))).scalar()
    # rank over the (at most k) kept rows only
    return sizes.orderBy(*orders).limit(k).select(group, "n", F.row_number().over(Window.orderBy(*orders)).alias("rank"),
                                                  total.alias("total_groups"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, share)``; the share's denominator is a window over the
    already-aggregated class table (a handful of rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "n",
                         F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), ROUND).alias("share"))


def histogram(df: DataFrame, col: str, bins: int = 50, upper: float | None = None) -> DataFrame:
    """Fixed-width bins over ``[min, max]`` of the values below ``upper``.

    Full data, no sample; the last bin is closed.  ``(bin, lo, hi, n)``.
    """
    x = F.col(col).cast("double")
    kept = df.select(x.alias("x")).where(F.col("x").isNotNull())
    if upper is not None:
        kept = kept.where(F.col("x") < upper)
    rng = kept.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = kept.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", F.round(lo + F.col("bin") * width, ROUND).alias("lo"),
                         F.round(lo + (F.col("bin") + 1) * width, ROUND).alias("hi"), "n")


def box_stats(df: DataFrame, by: str, col: str, upper: float | None = None,
              exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Per class q1, median, q3, 1.5-IQR fences, whisker ends and
    outlier count, over the values below ``upper``.

    ``exact=True`` interpolates linearly like the plotting library did, ranking distinct values over
    range partitions, so no task holds a class; ``exact=False`` takes a ``percentile_approx`` sketch of fixed size.
    """
    x = F.col(col).cast("double")
    kept = df.select(F.col(by), x.alias("x")).where(F.col("x").isNotNull())
    if upper is not None:
        kept = kept.where(F.col("x") < upper)
    probs = [0.25, 0.5, 0.75]
    if exact:
        q = exact_quantiles(kept, "x", probs, [by], linear=True)
    else:
        q = kept.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", probs, accuracy).alias("q"))
    q = q.select(by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("lower_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("upper_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # one row per class, stored once; joined back by broadcast when the
    # counted table is small, with hot classes taken apart otherwise
    q = materialize(q)
    j = join_group_table(kept, q.select(by, "lower_fence", "upper_fence", F.col("n").alias("__size")),
                         [by], how="inner", size_col="__size").drop("__size")
    inside = (F.col("x") >= F.col("lower_fence")) & (F.col("x") <= F.col("upper_fence"))
    w = j.groupBy(by).agg(F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
                          F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
                          F.count_if(~inside).alias("outliers"))
    out = q.join(w, by)
    return out.select(by, "n", *[F.round(c, ROUND).alias(c) for c in
                                 ["q1", "median", "q3", "lower_fence", "upper_fence", "whisker_low", "whisker_high"]],
                      "outliers")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every pair ``a < b`` in ``cols`` order, long form.

    One pass: ``covar_pop`` / ``var_pop`` are Spark's numerically stable
    (centred, mergeable) moment aggregates, so no separate mean pass is
    needed.  NULL when a column is constant, where ANSI ``corr`` would raise.
    """
    xs = {c: F.col(c).cast("double") for c in cols}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [F.var_pop(xs[c]).alias(f"v__{c}") for c in cols]
    aggs += [F.covar_pop(xs[a], xs[b]).alias(f"c__{a}__{b}") for a, b in pairs]
    row = df.agg(*aggs)
    return rows_from(row, [{"col_a": F.lit(a), "col_b": F.lit(b),
                            "corr": F.round(F.col(f"c__{a}__{b}") /
                                            F.nullif(F.sqrt(F.col(f"v__{a}") * F.col(f"v__{b}")), F.lit(0.0)),
                                            ROUND)}
                           for a, b in pairs])


def _class_means(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])


def _long_means(per_class: DataFrame, label: str, cols: list[str]) -> DataFrame:
    return per_class.unpivot([label], cols, "feature", "mean").select(label, "feature", F.round("mean", ROUND).alias("mean"))


def class_profile_long(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """B12 for any number of classes: ``(label, feature, mean)``, one row per class and feature, from one grouped pass."""
    return _long_means(_class_means(df, label, cols), label, cols)


def class_profile(df: DataFrame, label: str, cols: list[str], classes: tuple | None = None) -> DataFrame:
    """``(feature, mean_<c>..., diff)`` -- mean per class and the
    difference last minus first.  One grouped pass; the unpivot/pivot act on
    the tiny per-class table.  The classes are those of the data, in order (rows
    without a class are left out); given ``classes`` must cover them.  Above ``MAX_CLASSES``
    classes a column per class is no use: the result is that of ``class_profile_long``."""
    per_class = materialize(_class_means(df, label, cols))
    found = [r[0] for r in per_class.select(label).orderBy(label).limit(MAX_CLASSES + 1).collect()]
    if len(found) > MAX_CLASSES and classes is None:
        return _long_means(per_class, label, cols)
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has classes outside the {len(classes)} that were given")
    if classes is None:
        classes = tuple(found)
    elif not set(found) <= set(classes):
        raise ValueError(f"{label} has classes outside {classes}: {sorted(set(found) - set(classes))}")
    long = per_class.unpivot([label], cols, "feature", "mean")
    wide = long.groupBy("feature").pivot(label, list(classes)).agg(F.first("mean"))
    names = [f"mean_{c}" for c in classes]
    for c, n in zip(classes, names):
        wide = wide.withColumnRenamed(str(c), n)
    if not names:
        return wide.select("feature", F.lit(None).cast("double").alias("diff"))
    return wide.select("feature", *[F.round(n, ROUND).alias(n) for n in names],
                       F.round(F.col(names[-1]) - F.col(names[0]), ROUND).alias("diff"))


def quality_funnel(df: DataFrame, steps: list[tuple[str, object]]) -> DataFrame:
    """Rows before / after / removed per cleaning step, one pass.

    ``steps`` is a list of ``(name, predicate Column)`` or
    ``(name, "dedup:<key>")``; steps are cumulative.
    """
    aggs, names, cond = [F.count(F.lit(1)).alias("s0")], [], F.lit(True)
    for i, (name, step) in enumerate(steps, start=1):
        names.append(name)
        if isinstance(step, str) and step.startswith("dedup:"):
            k = F.col(step.split(":", 1)[1])
            aggs.append((F.countDistinct(F.when(cond, k)) +
                         F.coalesce(F.max(F.when(cond & k.isNull(), 1)), F.lit(0))).alias(f"s{i}"))
        else:
            cond = cond & F.coalesce(step, F.lit(False))
            aggs.append(F.count_if(cond).alias(f"s{i}"))
    row = df.agg(*aggs)
    return rows_from(row, [{"step_no": F.lit(i), "step": F.lit(n),
                            "rows_before": F.col(f"s{i - 1}").cast("bigint"),
                            "rows_after": F.col(f"s{i}").cast("bigint"),
                            "removed": (F.col(f"s{i - 1}") - F.col(f"s{i}")).cast("bigint")}
                           for i, n in enumerate(names, start=1)])


def schema_info(df: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """``(position, column, type, role)`` from the schema itself."""
    roles = roles or {}
    rows = [(i + 1, f.name, f.dataType.simpleString(), roles.get(f.name, "attribute"))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, role string")


def preview(df: DataFrame, n: int, order_by: str, truncate: int = 80) -> DataFrame:
    """First ``n`` rows by ``order_by`` with strings cut to ``truncate``."""
    sel = [F.substring(F.col(f.name), 1, truncate).alias(f.name)
           if isinstance(f.dataType, T.StringType) else F.col(f.name)
           for f in df.schema.fields]
    return df.orderBy(order_by).limit(n).select(*sel)
