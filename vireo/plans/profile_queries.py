"""Queries for profiling, cleaning and labelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators import clean, label, profile
from vireo.operators.features import eda_features, text_features
from vireo.plans.registry import ORACLE, POSTS_SQL, posts, query, table
from vireo.plans.sqlbits import features_sql, rnd, union_all

DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
CUST_NUM = ["c_acctbal", "c_nationkey"]

# --------------------------------------------------------------- flagship

_FEATS_REF = ",\n       ".join(features_sql("d.text", "split_part(d.text, chr(10), 1)", "ref"))
_MEANS = ", ".join(f"avg({n}) AS {n}" for n in NUMERIC_FEATURES)


@query("class_profile", f"""
WITH f AS (SELECT l.quality AS quality,
       {_FEATS_REF}
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT quality, {_MEANS} FROM f GROUP BY quality),
lng AS (UNPIVOT m ON {", ".join(NUMERIC_FEATURES)} INTO NAME feature VALUE mean)
SELECT feature,
       {rnd("max(CASE WHEN quality = 0 THEN mean END)")} AS mean_0,
       {rnd("max(CASE WHEN quality = 1 THEN mean END)")} AS mean_1,
       {rnd("max(CASE WHEN quality = 1 THEN mean END) - max(CASE WHEN quality = 0 THEN mean END)")} AS diff
FROM lng GROUP BY feature""")
def q_class_profile(spark, sf):
    """Flagship: documents -> 13 ref features -> ⋈ labels -> mean per quality class."""
    feats = text_features(posts(spark, sf), "text", "summary", mode="ref")
    labelled = feats.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return profile.class_profile(labelled, "quality", NUMERIC_FEATURES)


# --------------------------------------------------------------- profiling

def _blank(c: str) -> str:
    return f"sum(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN 1 ELSE 0 END)::BIGINT AS {c}"


@query("missing_profile", f"""
WITH a AS (SELECT count(*) AS __rows, {", ".join(_blank(c) for c in DOC_COLS)} FROM documents)
SELECT "column", missing,
       {rnd("CASE WHEN __rows > 0 THEN missing * 100.0 / __rows ELSE 0.0 END")} AS pct
FROM (UNPIVOT a ON {", ".join(DOC_COLS)} INTO NAME "column" VALUE missing)""")
def q_missing_profile(spark, sf):
    return profile.missing_profile(table(spark, sf, "documents"))


_LEFT_SQL = ("(SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality, l.toxic "
             "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
_LEFT_COLS = ["doc_id", "text", "lang", "n_chars", "quality", "toxic"]


def _docs_left_labels(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    return d.join(table(spark, sf, "labels"), "doc_id", "left")


@query("null_profile", f"""
WITH a AS (SELECT count(*) AS __rows,
  {", ".join(f"count_if({c} IS NULL)::BIGINT AS {c}" for c in _LEFT_COLS)} FROM {_LEFT_SQL})
SELECT "column", nulls,
       {rnd("CASE WHEN __rows > 0 THEN nulls * 100.0 / __rows ELSE 0.0 END")} AS pct,
       CASE WHEN (CASE WHEN __rows > 0 THEN nulls * 100.0 / __rows ELSE 0.0 END) < 5.0 THEN 'OK' ELSE 'WARN' END AS status
FROM (UNPIVOT a ON {", ".join(_LEFT_COLS)} INTO NAME "column" VALUE nulls)""")
def q_null_profile(spark, sf):
    return profile.null_profile(_docs_left_labels(spark, sf).select(*_LEFT_COLS), warn_pct=5.0)


@query("describe_numeric", union_all([f"""
SELECT '{c}' AS "column", count({c})::BIGINT AS count, {rnd(f"avg({c})")} AS mean,
       {rnd(f"stddev_samp({c})")} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median,
       CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q3
FROM customer""" for c in CUST_NUM]))
def q_describe_numeric(spark, sf):
    return profile.describe_numeric(table(spark, sf, "customer"), CUST_NUM)


@query("describe_linear", union_all([f"""
SELECT '{c}' AS "column", count({c})::BIGINT AS count, {rnd(f"avg({c})")} AS mean,
       {rnd(f"stddev_samp({c})")} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       {rnd(f"quantile_cont({c}, 0.25)")} AS q1, {rnd(f"quantile_cont({c}, 0.5)")} AS median,
       {rnd(f"quantile_cont({c}, 0.75)")} AS q3
FROM lineitem""" for c in ["l_quantity", "l_discount"]]))
def q_describe_linear(spark, sf):
    """Interpolated quartiles like pandas' describe (exact percentile, on
    columns with few distinct values: quantities and discounts)."""
    out = profile.describe_numeric(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], method="linear")
    return out.select("column", "count", "mean", "stddev", "min", "max",
                      *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


@query("dataset_overview", f"""
WITH g AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
t AS (SELECT CAST(quantile_disc(n, 0.8) AS DOUBLE) AS thr FROM g),
s AS (SELECT count(*) AS groups, sum(CASE WHEN n >= thr THEN 1 ELSE 0 END) AS active,
             sum(CASE WHEN n >= thr THEN n ELSE 0 END) AS pos FROM g, t),
w AS (SELECT CAST((SELECT count(*) FROM documents) AS DOUBLE) AS "rows", 5.0 AS "columns",
             CAST(groups AS DOUBLE) AS groups, (SELECT thr FROM t) AS threshold,
             CAST(active AS DOUBLE) AS active_groups, CAST(groups - active AS DOUBLE) AS inactive_groups,
             CAST(pos AS DOUBLE) AS positive_rows,
             CAST((SELECT count(*) FROM documents) - pos AS DOUBLE) AS negative_rows FROM s)
SELECT metric, value FROM (UNPIVOT w ON "rows", "columns", groups, threshold, active_groups,
  inactive_groups, positive_rows, negative_rows INTO NAME metric VALUE value)""")
def q_dataset_overview(spark, sf):
    return profile.dataset_overview(table(spark, sf, "documents"), "lang", 0.8, "element")


_EXPECTED = ["doc_id", "text", "lang", "summary", "author"]


@query("schema_check", f"""
WITH actual AS (SELECT column_name AS "column" FROM (DESCRIBE documents)),
want AS (SELECT unnest({_EXPECTED!r}) AS "column")
SELECT "column", 'missing' AS status FROM want WHERE "column" NOT IN (SELECT "column" FROM actual)
UNION ALL
SELECT "column", 'extra' AS status FROM actual WHERE "column" NOT IN (SELECT "column" FROM want)""")
def q_schema_check(spark, sf):
    return profile.schema_check(table(spark, sf, "documents"), _EXPECTED)


_ROLES = {"doc_id": "id", "text": "text", "lang": "group", "n_chars": "feature"}


@query("schema_info", f"""
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END AS type,
       CASE column_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ROLES.items())} ELSE 'attribute' END AS role
FROM (DESCRIBE documents)""")
def q_schema_info(spark, sf):
    return profile.schema_info(table(spark, sf, "documents"), _ROLES)


@query("preview", """
SELECT doc_id, substr(text, 1, 80) AS text, substr(lang, 1, 80) AS lang, substr(source, 1, 80) AS source, n_chars
FROM documents ORDER BY doc_id LIMIT 5""")
def q_preview(spark, sf):
    return profile.preview(table(spark, sf, "documents"), 5, "doc_id")


@query("duplicate_count", """
SELECT count(*)::BIGINT AS "rows",
       (count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END))::BIGINT AS distinct_keys,
       (count(*) - count(DISTINCT text) - max(CASE WHEN text IS NULL THEN 1 ELSE 0 END))::BIGINT AS duplicates
FROM documents""")
def q_duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "documents"), "text")


@query("dedup_text", """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def q_dedup_text(spark, sf):
    return clean.dedup(table(spark, sf, "documents"), ["text"], "doc_id")


@query("quality_funnel", """
WITH a AS (SELECT count(*) AS s0,
  count_if(text IS NOT NULL AND lang IS NOT NULL) AS s1,
  count_if(text IS NOT NULL AND lang IS NOT NULL AND length(text) > 10) AS s2,
  count(DISTINCT CASE WHEN text IS NOT NULL AND lang IS NOT NULL AND length(text) > 10 THEN text END)
    + coalesce(max(CASE WHEN text IS NOT NULL AND lang IS NOT NULL AND length(text) > 10 AND text IS NULL THEN 1 END), 0) AS s3
  FROM documents)
SELECT 1 AS step_no, 'drop_missing' AS step, s0::BIGINT AS rows_before, s1::BIGINT AS rows_after, (s0 - s1)::BIGINT AS removed FROM a
UNION ALL SELECT 2, 'min_length', s1::BIGINT, s2::BIGINT, (s1 - s2)::BIGINT FROM a
UNION ALL SELECT 3, 'dedup', s2::BIGINT, s3::BIGINT, (s2 - s3)::BIGINT FROM a""")
def q_quality_funnel(spark, sf):
    t, g = F.col("text"), F.col("lang")
    steps = [("drop_missing", t.isNotNull() & g.isNotNull()),
             ("min_length", F.length(t) > 10),
             ("dedup", "dedup:text")]
    return profile.quality_funnel(table(spark, sf, "documents"), steps)


# ------------------------------------------------------ distributions

@query("group_distribution", """
WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) AS INTEGER) AS rank,
       (SELECT count(*) FROM s) AS total_groups
FROM s ORDER BY n DESC, user_id LIMIT 30""")
def q_group_distribution(spark, sf):
    return profile.group_distribution(table(spark, sf, "events"), "user_id", k=30)


@query("class_distribution", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT quality, n, round(n / sum(n) OVER (), 6) AS share FROM c""")
def q_class_distribution(spark, sf):
    return profile.class_distribution(table(spark, sf, "labels"), "quality")


@query("histogram_chars", """
WITH k AS (SELECT CAST(n_chars AS DOUBLE) AS x FROM documents WHERE n_chars IS NOT NULL AND n_chars < 5000),
r AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50.0 AS w FROM k),
b AS (SELECT CAST(CASE WHEN w > 0 THEN least(floor((x - lo) / w), 49) ELSE 0 END AS INTEGER) AS bin, count(*) AS n
      FROM k, r GROUP BY 1)
SELECT bin, round(lo + bin * w, 6) AS lo, round(lo + (bin + 1) * w, 6) AS hi, n FROM b, r""")
def q_histogram_chars(spark, sf):
    return profile.histogram(table(spark, sf, "documents"), "n_chars", bins=50, upper=5000)


_BOX_BASE = """(SELECT l.quality, CAST(d.n_chars AS DOUBLE) AS x FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE d.n_chars IS NOT NULL AND d.n_chars < 5000)"""


@query("box_stats", f"""
WITH k AS {_BOX_BASE},
q AS (SELECT quality, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM k GROUP BY quality),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
w AS (SELECT k.quality, min(CASE WHEN x >= lower_fence AND x <= upper_fence THEN x END) AS whisker_low,
             max(CASE WHEN x >= lower_fence AND x <= upper_fence THEN x END) AS whisker_high,
             count_if(NOT (x >= lower_fence AND x <= upper_fence))::BIGINT AS outliers
      FROM k JOIN f ON k.quality = f.quality GROUP BY k.quality)
SELECT f.quality, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
       round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, outliers
FROM f JOIN w ON f.quality = w.quality""")
def q_box_stats(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return profile.box_stats(j, "quality", "n_chars", upper=5000)


_EDA = {"body_length": "CAST(length(text) AS DOUBLE)", "summary_length": "CAST(length(split_part(text, chr(10), 1)) AS DOUBLE)",
        "word_count": r"CAST(len(string_split_regex(text, '\s+')) AS DOUBLE)", "has_url": "CASE WHEN regexp_matches(text, 'https?://') THEN 1.0 ELSE 0.0 END",
        "question_marks": "CAST(length(text) - length(replace(text, '?', '')) AS DOUBLE)", "exclamation_marks": "CAST(length(text) - length(replace(text, '!', '')) AS DOUBLE)"}
# The plots' upper limits.
_EDA_UPPER = {"summary_length": 500, "word_count": 1000}


def _eda(spark, sf):
    return eda_features(posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"), "text", "summary", "quality")


def _eda_histogram(col: str):
    @query(f"histogram_{col}", ORACLE["histogram_chars"].replace("SELECT CAST(n_chars AS DOUBLE) AS x FROM documents WHERE n_chars IS NOT NULL AND n_chars < 5000",
                                                                 f"SELECT x FROM (SELECT {_EDA[col]} AS x FROM documents JOIN labels USING (doc_id)) WHERE x < {_EDA_UPPER[col]}"))
    def run(spark, sf):
        return profile.histogram(_eda(spark, sf), col, bins=50, upper=_EDA_UPPER[col])

    @query(f"box_{col}", ORACLE["box_stats"].replace(_BOX_BASE, f"(SELECT * FROM (SELECT quality, {_EDA[col]} AS x FROM documents JOIN labels USING (doc_id)) WHERE x < {_EDA_UPPER[col]})"))
    def box(spark, sf):
        return profile.box_stats(_eda(spark, sf), "quality", col, upper=_EDA_UPPER[col])


for _col in _EDA_UPPER:
    _eda_histogram(_col)


_CORR_COLS = ["char_count", "word_count", "sentence_count", "uppercase_ratio", "quality"]


def _corr_sql() -> str:
    feats = features_sql("d.text", "split_part(d.text, chr(10), 1)", "ref")
    keep = [f for f in feats if f.rsplit(" AS ", 1)[1] in _CORR_COLS]
    means = ", ".join(f"avg({c}) AS m_{c}" for c in _CORR_COLS)
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
    parts = []
    for a, b in pairs:
        parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
  round(sum((f.{a} - m_{a}) * (f.{b} - m_{b})) /
        nullif(sqrt(sum((f.{a} - m_{a}) * (f.{a} - m_{a}))) * sqrt(sum((f.{b} - m_{b}) * (f.{b} - m_{b}))), 0.0), 6) AS corr
FROM f, m""")
    return (f"WITH f AS (SELECT {', '.join(keep)}, CAST(l.quality AS DOUBLE) AS quality "
            f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id),\nm AS (SELECT {means} FROM f)\n"
            + union_all(parts))


@query("correlation", _corr_sql())
def q_correlation(spark, sf):
    feats = text_features(posts(spark, sf), "text", "summary", mode="ref")
    j = feats.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return profile.correlation_matrix(j, _CORR_COLS)


_EDA_PAIRS = [(x, y) for i, x in enumerate([*_EDA, "quality"]) for y in [*_EDA, "quality"][i + 1:]]


@query("correlation_eda", f"""
WITH f AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _EDA.items())}, CAST(quality AS DOUBLE) AS quality FROM documents JOIN labels USING (doc_id)),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in (*_EDA, 'quality'))} FROM f)
""" + union_all([f"""SELECT '{x}' AS col_a, '{y}' AS col_b, round(sum(({x} - m_{x}) * ({y} - m_{y})) /
  nullif(sqrt(sum(({x} - m_{x}) * ({x} - m_{x}))) * sqrt(sum(({y} - m_{y}) * ({y} - m_{y}))), 0.0), 6) AS corr FROM f, m""" for x, y in _EDA_PAIRS]))
def q_correlation_eda(spark, sf):
    """B11 on the exploratory columns."""
    return profile.correlation_matrix(_eda(spark, sf), [*_EDA, "quality"])


# ------------------------------------------------------ cleaning

@query("drop_missing", f"""
SELECT * FROM {_LEFT_SQL} WHERE quality IS NOT NULL AND text IS NOT NULL""")
def q_drop_missing(spark, sf):
    return clean.drop_missing(_docs_left_labels(spark, sf).select(*_LEFT_COLS), ["quality", "text"])


@query("fill_text", f"""
SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, n_chars, quality, toxic
FROM {_LEFT_SQL}""")
def q_fill_text(spark, sf):
    return clean.fill_text(_docs_left_labels(spark, sf).select(*_LEFT_COLS), ["text", "lang"])


@query("fill_numeric", f"""
SELECT doc_id, text, lang, n_chars, coalesce(CAST(quality AS DOUBLE), 0.0) AS quality,
       coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic
FROM {_LEFT_SQL}""")
def q_fill_numeric(spark, sf):
    return clean.fill_numeric(_docs_left_labels(spark, sf).select(*_LEFT_COLS), ["quality", "toxic"])


@query("min_length", f"""
SELECT * FROM {POSTS_SQL} WHERE length(text) > 10 AND length(summary) > 5""")
def q_min_length(spark, sf):
    return clean.min_length(posts(spark, sf), {"text": 10, "summary": 5})


@query("as_label", f"""
SELECT doc_id, n_chars, CAST(quality AS DOUBLE) AS label FROM {_LEFT_SQL}
WHERE quality IS NOT NULL AND n_chars IS NOT NULL""")
def q_as_label(spark, sf):
    d = _docs_left_labels(spark, sf).select("doc_id", "n_chars", "quality")
    return clean.as_label(d, "quality", ["n_chars"])


# ------------------------------------------------------ activity labels

@query("activity_threshold_element", """
SELECT CAST(quantile_disc(n, 0.8) AS DOUBLE) AS threshold
FROM (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id)""")
def q_threshold_element(spark, sf):
    return label.activity_threshold(table(spark, sf, "events"), "user_id", 0.8, "element")


@query("activity_threshold_linear", """
SELECT CAST(round(quantile_cont(n, 0.8), 6) AS DOUBLE) AS threshold
FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)""")
def q_threshold_linear(spark, sf):
    return label.activity_threshold(table(spark, sf, "orders"), "o_custkey", 0.8, "linear")


def _label_sql(tab: str, key: str, cols: list[str]) -> str:
    return f"""
WITH g AS (SELECT {key}, count(*) AS n FROM {tab} WHERE {key} IS NOT NULL GROUP BY {key}),
t AS (SELECT quantile_disc(n, 0.8) AS thr FROM g)
SELECT {", ".join("x." + c for c in cols)},
       coalesce(CAST(g.n >= t.thr AS INTEGER), 0) AS is_active
FROM {tab} x LEFT JOIN g ON x.{key} = g.{key} CROSS JOIN t"""


_EV_COLS = ["event_id", "user_id", "event_type", "value"]
_ORD_COLS = ["o_orderkey", "o_custkey", "o_totalprice"]
_LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@query("activity_label_events", _label_sql("events", "user_id", _EV_COLS))
def q_label_events(spark, sf):
    return label.activity_label(table(spark, sf, "events").select(*_EV_COLS), "user_id").select(*_EV_COLS, "is_active")


@query("activity_label_orders", _label_sql("orders", "o_custkey", _ORD_COLS))
def q_label_orders(spark, sf):
    return label.activity_label(table(spark, sf, "orders").select(*_ORD_COLS), "o_custkey").select(*_ORD_COLS, "is_active")


@query("activity_label_lineitem", _label_sql("lineitem", "l_partkey", _LI_COLS))
def q_label_lineitem(spark, sf):
    return label.activity_label(table(spark, sf, "lineitem").select(*_LI_COLS), "l_partkey").select(*_LI_COLS, "is_active")


@query("active_groups", """
WITH g AS (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
t AS (SELECT CAST(quantile_disc(n, 0.8) AS DOUBLE) AS thr FROM g)
SELECT user_id, n, thr AS threshold, CAST(n >= thr AS INTEGER) AS is_active FROM g, t WHERE n >= thr""")
def q_active_groups(spark, sf):
    return label.active_groups(table(spark, sf, "events"), "user_id", 0.8, "element", active=True)


# whole cents and per cents, whose sums don't depend on their order
_PART_MEANS = {"quantity": "l_quantity", "price_cents": "l_extendedprice * 100", "discount_pct": "l_discount * 100"}


@query("class_profile_long", "\nUNION ALL\n".join(
    f"SELECT l_partkey, '{c}' AS feature, {rnd(f'avg(CAST(round({e}) AS BIGINT))')} AS mean FROM lineitem GROUP BY l_partkey" for c, e in _PART_MEANS.items()))
def q_class_profile_long(spark, sf):
    """Means per part: as many classes as there are parts, so one row each instead of one column."""
    lines = table(spark, sf, "lineitem").select("l_partkey", *[F.expr(f"CAST(round({e}) AS BIGINT)").alias(c) for c, e in _PART_MEANS.items()])
    return profile.class_profile_long(lines, "l_partkey", list(_PART_MEANS))
