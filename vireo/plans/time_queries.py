"""Queries over event time, levels and mergeable state: as-of and interval joins, sessions, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vireo.operators import levels, sampling, sketches, temporal
from vireo.plans.registry import query, table
from vireo.plans.sqlbits import u32
from vireo.session import scratch_dir
from vireo.streaming import windows_stream as ws


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_LAST = "SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY ALL"


@query("asof_events_orders", f"""
SELECT e.event_id, e.user_id, o.o_orderkey, o.o_totalprice
FROM events e ASOF LEFT JOIN ({_LAST}) o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate""")
def q_asof_events_orders(spark, sf):
    """Each event with its user's latest order before it."""
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).withColumnRenamed("o_custkey", "user_id")
    out = temporal.asof_join(_events(spark, sf), orders, ["user_id"], "ts", "o_orderdate", ["o_orderkey", "o_totalprice"])
    return out.select("event_id", "user_id", "o_orderkey", "o_totalprice")


@query("asof_previous_order", f"""
SELECT a.o_orderkey, b.o_orderkey AS previous_key, b.o_totalprice AS previous_price
FROM orders a ASOF LEFT JOIN ({_LAST}) b ON a.o_custkey = b.o_custkey AND a.o_orderdate > b.o_orderdate""")
def q_asof_previous_order(spark, sf):
    """Each order with its customer's latest order of an earlier day."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    earlier = orders.select("o_custkey", F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("previous_key"), F.col("o_totalprice").alias("previous_price"))
    return temporal.asof_join(orders, earlier, ["o_custkey"], "o_orderdate", "day", ["previous_key", "previous_price"], strict=True).select("o_orderkey", "previous_key", "previous_price")


# orders end in 2001 and events are of 2024, so windows are moved on by a fixed number of days
_MOVED_DAYS, _WINDOW_HOURS = 8250, 18


@query("interval_order_windows", f"""
SELECT o.o_orderkey, count(*) AS events, min(e.event_id) AS first_event, max(e.event_id) AS last_event
FROM orders o JOIN events e ON e.ts >= o.o_orderdate + INTERVAL {_MOVED_DAYS} DAY AND e.ts < o.o_orderdate + INTERVAL {_MOVED_DAYS} DAY + INTERVAL {_WINDOW_HOURS} HOUR
GROUP BY o.o_orderkey""")
def q_interval_order_windows(spark, sf):
    """Events inside a window that opens with each order; no key joins them, only time."""
    start = F.col("o_orderdate").cast("timestamp") + F.expr(f"INTERVAL {_MOVED_DAYS} DAYS")
    windows = table(spark, sf, "orders").select("o_orderkey", start.alias("opens"), (start + F.expr(f"INTERVAL {_WINDOW_HOURS} HOURS")).alias("closes"))
    met = temporal.interval_join(windows, _events(spark, sf).select("event_id", "ts"), ("opens", "closes"), "ts", _WINDOW_HOURS * 3600, totals_of="event_id")
    return met.groupBy("o_orderkey").agg(F.sum("n").alias("events"), F.min("least").alias("first_event"), F.max("most").alias("last_event"))


_OVERLAP = """SELECT o_custkey, o_orderkey, o_orderdate AS f, o_orderdate + INTERVAL 20 DAY AS t FROM orders"""


@query("interval_overlaps", f"""
SELECT a.o_custkey, a.o_orderkey AS a_key, b.o_orderkey AS b_key
FROM ({_OVERLAP}) a JOIN ({_OVERLAP}) b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.f < b.t AND b.f < a.t""")
def q_interval_overlaps(spark, sf):
    """Pairs of a customer's orders whose twenty days overlap."""
    at = F.col("o_orderdate").cast("timestamp")
    side = lambda x: table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias(f"{x}_key"), at.alias(f"{x}_from"), (at + F.expr("INTERVAL 20 DAYS")).alias(f"{x}_to"))
    met = temporal.interval_join(side("a"), side("b"), ("a_from", "a_to"), ("b_from", "b_to"), 20 * 86_400, ["o_custkey"])
    return met.where("a_key < b_key").select("o_custkey", "a_key", "b_key")


_GAP = 6 * 3600
_SESSIONS = f"""
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + {_GAP * 1_000_000} AS end_us, count(*) AS n
FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth
      FROM (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < {_GAP * 1_000_000} THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY user_id, nth"""


def _session_rows(s):
    return s.select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n")


@query("sessions", _SESSIONS)
def q_sessions(spark, sf):
    return _session_rows(temporal.session_windows(_events(spark, sf), ["user_id"], "ts", _GAP))


def _replayed(spark, rows, time_col, files, lateness_seconds, close_seconds):
    """``rows`` as files in time order, moved by up to ``lateness_seconds`` by a hash; with a closing row if asked. (folder, schema)"""
    root = scratch_dir(spark, f"stream-{uuid.uuid4().hex}")
    first, last = rows.agg(F.unix_micros(F.min(time_col)), F.unix_micros(F.max(time_col))).first()
    moved = F.unix_micros(F.col(time_col)) + F.pmod(F.xxhash64("event_id"), F.lit(lateness_seconds * 1_000_000 + 1))
    ws.replay(rows, f"{root}/source", (moved - F.lit(first)) / F.lit((last or 0) - (first or 0) + lateness_seconds * 1_000_000 + 1), files)
    ws.closing_row(rows, time_col, close_seconds).write.mode("append").parquet(f"{root}/source")
    return root, rows.schema


_STREAM_FILES, _DELAY = 5, 2 * 86_400


@query("stream_sessions", _SESSIONS)
def q_stream_sessions(spark, sf):
    rows = _events(spark, sf).select("event_id", "ts", "user_id")
    root, schema = _replayed(spark, rows, "ts", _STREAM_FILES, _DELAY, _GAP + 2 * _DELAY)
    ws.drain(ws.sessions(ws.file_stream(spark, f"{root}/source", schema), "user_id", "ts", f"{_GAP} seconds", f"{_DELAY} seconds"), f"{root}/sink", f"{root}/checkpoint")
    return _session_rows(spark.read.parquet(f"{root}/sink"))


_DAY_LABELS = """
WITH sizes AS (SELECT date_trunc('day', ts) AS day, user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
limits AS (SELECT day, CAST(quantile_disc(n, 0.8) AS DOUBLE) AS threshold FROM sizes GROUP BY day)
SELECT epoch(s.day)::BIGINT AS day_s, s.user_id, s.n, l.threshold, CAST(s.n >= l.threshold AS INTEGER) AS is_active FROM sizes s JOIN limits l USING (day)"""


def _stream_labels(spark, sf, lateness):
    rows = _events(spark, sf).select("event_id", "ts", "user_id")
    root, schema = _replayed(spark, rows, "ts", _STREAM_FILES, lateness, 86_400 + 2 * _DELAY)
    sizes = ws.window_sizes(ws.file_stream(spark, f"{root}/source", schema), "user_id", "ts", "1 day", f"{_DELAY} seconds")
    ws.drain(sizes, f"{root}/sink", f"{root}/checkpoint")
    return ws.window_labels(spark.read.parquet(f"{root}/sink")).select(F.unix_seconds("window_start").alias("day_s"), "user_id", "n", "threshold", "is_active")


@query("stream_activity_label", _DAY_LABELS)
def q_stream_activity_label(spark, sf):
    """Users by how active they are each day, from a stream in time order."""
    return _stream_labels(spark, sf, 0)


@query("stream_activity_label_late", _DAY_LABELS)
def q_stream_activity_label_late(spark, sf):
    """The same rows, each up to two days late."""
    return _stream_labels(spark, sf, _DELAY)


@query("stream_dedup", "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def q_stream_dedup(spark, sf):
    """Documents as they arrive, in the order of their ids; the delay covers all ids, so the result is the batch's."""
    docs = table(spark, sf, "documents").withColumn("arrived", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id")))
    span = (docs.agg(F.max("doc_id") - F.min("doc_id")).first()[0] or 0) + 1
    root = scratch_dir(spark, f"stream-{uuid.uuid4().hex}")
    at = (F.col("doc_id") - docs.agg(F.min("doc_id")).scalar()) / F.lit(span)
    ws.replay(docs.sort("doc_id"), f"{root}/source", at, _STREAM_FILES)
    out = ws.first_seen(ws.file_stream(spark, f"{root}/source", docs.schema), ["text"], "arrived", f"{span} seconds").select("doc_id", "lang", "source")
    ws.drain(out, f"{root}/sink", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/sink")


_FACTS = "(SELECT d.lang, d.source, l.quality, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_DIMS = ["lang", "source", "quality"]


def _levels(name, clause, sets):
    @query(name, f"""
SELECT lang, source, quality, count(*) AS n, sum(n_chars)::BIGINT AS chars, CAST(GROUPING(lang, source, quality) AS INTEGER) AS level
FROM {_FACTS} GROUP BY {clause}""")
    def q(spark, sf):
        facts = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
        return levels.grouping_levels(facts, _DIMS, {"n": F.lit(1), "chars": F.col("n_chars")}, sets)


_levels("levels_cube", "CUBE (lang, source, quality)", levels.cube_sets(_DIMS))
_levels("levels_rollup", "ROLLUP (lang, source, quality)", levels.rollup_sets(_DIMS))
_levels("levels_sets", "GROUPING SETS ((lang, quality), (source), ())", [["lang", "quality"], ["source"], []])


_PROBS = [0.25, 0.5, 0.75]


@query("profile_merge", """
SELECT epoch(date_trunc('week', ts))::BIGINT AS week_s, count(*) AS "rows", min(value) AS value_min, max(value) AS value_max, round(sum(value), 2) AS value_sum,
       TRUE AS users_close, TRUE AS types_exact, TRUE AS quartiles_close
FROM events GROUP BY 1""")
def q_profile_merge(spark, sf):
    """Weeks from daily states: numbers exact, distinct users within 3 %, quartiles within 1 % of ranks."""
    events = _events(spark, sf)
    daily = sketches.profile_state(events.withColumn("day", F.date_trunc("day", "ts")), ["day"], ["user_id", "event_type"], ["value"])
    weekly = sketches.read_state(sketches.merge_states(daily.withColumn("week", F.date_trunc("week", "day")).drop("day"), ["week"]), _PROBS)
    exact = events.groupBy(F.date_trunc("week", "ts").alias("week")).agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types"))
    ranks = events.withColumn("week", F.date_trunc("week", "ts")).join(weekly.select("week", "value_q"), "week").groupBy("week").agg(
        *[F.avg((F.col("value") <= F.col("value_q")[i]).cast("double")).alias(f"upto{i}") for i in range(3)],
        *[F.avg((F.col("value") < F.col("value_q")[i]).cast("double")).alias(f"below{i}") for i in range(3)])
    close = F.lit(True)
    for i, p in enumerate(_PROBS):
        close = close & (F.col(f"below{i}") <= p + 0.01) & (F.col(f"upto{i}") >= p - 0.01)
    out = weekly.join(exact, "week").join(ranks, "week")
    return out.select(F.unix_seconds("week").alias("week_s"), "rows", "value_min", "value_max", F.round("value_sum", 2).alias("value_sum"),
                      (F.abs(F.col("user_id_distinct") - F.col("users")) <= 0.03 * F.col("users") + 0.5).alias("users_close"),
                      (F.col("event_type_distinct") == F.col("types")).alias("types_exact"), close.alias("quartiles_close"))


@query("exact_sample", f"SELECT doc_id, lang, source FROM documents ORDER BY {u32('doc_id')}, doc_id LIMIT 250")
def q_exact_sample(spark, sf):
    return sampling.exact_sample(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id", 250)


@query("exact_sample_by_class", f"SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {u32('doc_id')}, doc_id) <= 40")
def q_exact_sample_by_class(spark, sf):
    return sampling.exact_sample(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id", 40, ["lang"])
