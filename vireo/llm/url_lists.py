"""Operator 3: URL filter by a temporal list join.

List entries are dated changes: at ``changed_at`` a (list, scope, pattern) becomes ``block``, ``allow`` or
``remove``.  Consecutive changes become validity intervals [from, to), and every capture is evaluated against
the entries that were valid when it was fetched.  Only DataFrame functions are used.

Scopes, from general to specific: ``domain`` (the host or a parent domain of it), ``host`` (the host itself),
``prefix`` (host and path start with the pattern, which ends with ``/``).  The most specific valid entry decides,
the longer pattern inside a scope, ``block`` before ``allow`` between equals, then the smaller list name.

The as-of join is an equi-join on (scope, pattern, time slot): intervals stand in every slot they touch, captures
in one, so one host with a third of all captures is spread over the slots, and adaptive execution may split what
is still skewed.  There are at most ``SLOTS`` slots over the captures' time range.  Captures are first reduced to
distinct (url, time); paths are only taken as deep as the longest pattern reaches.

Defined cases: a url that is null or has no host matches nothing (verdict ``none``); a null fetch time matches
nothing; entries with a null pattern, scope, action or time are left out; changes of one key at the same instant
count as one (block before allow before remove); repeated captures each get their verdict; empty tables give
an empty result or verdict ``none``; extra columns of the captures, with whatever names, take no part in the
search and stay; a capture's own column that has the name of a result column stays as ``capture_<name>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import stored

SLOTS = 256
SLOT_SECONDS = 7 * 86_400
#: Changes of one key are sequenced inside windows of this length first, so a key with many changes is spread.
SEQUENCE_SECONDS = 90 * 86_400
# Scopes from general to specific, and actions by the order in which the last one wins.
SCOPES = ("domain", "host", "prefix")
ACTIONS = ("remove", "allow", "block")


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; empty where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def url_path(url: Column) -> Column:
    """The path, at least ``/``."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def _position(value: Column, names: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in names]), value).cast("int")


def validity(entries: DataFrame) -> DataFrame:
    """list_name, scope, pattern, action, valid_from, valid_to (null: open) of block and allow entries.

    The next change of a key is found inside its window of time first, and past it from the windows' first
    changes, so no task gets all changes of a frequent key.
    """
    key = ["list_name", "scope", "pattern"]
    known = entries.where(F.col("pattern").isNotNull() & F.col("scope").isin(*SCOPES) & F.col("action").isin(*ACTIONS) & F.col("changed_at").isNotNull())
    changes = known.groupBy(*key, "changed_at").agg(F.max(_position(F.col("action"), ACTIONS)).alias("act"))
    changes = changes.withColumn("era", F.floor(F.unix_seconds("changed_at") / SEQUENCE_SECONDS))
    inside = Window.partitionBy(*key, "era").orderBy("changed_at")
    eras = changes.groupBy(*key, "era").agg(F.min("changed_at").alias("opens"))
    following = eras.withColumn("later", F.lead("opens").over(Window.partitionBy(*key).orderBy("era"))).drop("opens")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"f.{k}")) for k in (*key, "era")]
    ranged = changes.withColumn("next", F.lead("changed_at").over(inside)).alias("c").join(following.alias("f"), same)
    return (ranged.where("c.act > 1")
            .select(*[F.col(f"c.{k}") for k in key], F.element_at(F.array(*[F.lit(x) for x in ACTIONS]), F.col("c.act")).alias("action"),
                    F.col("c.changed_at").alias("valid_from"), F.coalesce("c.next", "f.later").alias("valid_to")))


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """One row per distinct (url, time): verdict, and the deciding entry with its validity."""
    lists = stored(validity(entries), "list-validity")
    seen = captures.select(F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{time_col}`").cast("timestamp").alias("at")).distinct()
    span = seen.agg(F.min("at").alias("lo"), F.max("at").alias("hi")).select(F.unix_seconds("lo"), F.unix_seconds("hi")).first()
    longest = lists.where("scope = 'prefix'").agg(F.max(F.length("pattern"))).first()[0] or 0
    lo, hi = (span[0], span[1]) if span[0] is not None else (0, 0)
    width = max(SLOT_SECONDS, (hi - lo) // SLOTS + 1)
    slot = lambda t: F.floor((F.unix_seconds(t) - lo) / width)

    parsed = seen.withColumn("host", url_host(F.col("url"))).withColumn("whole", F.concat("host", url_path(F.col("url")))).where((F.col("host") != "") & F.col("at").isNotNull())
    labels = F.split("host", r"\.")
    tagged = lambda scope, value: F.struct(F.lit(scope).alias("scope"), value.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: tagged("domain", F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")))
    reach = F.substring("whole", 1, longest) if longest else F.lit("")
    parts = F.split(reach, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: tagged("prefix", F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))
    keys = F.concat(domains, F.array(tagged("host", F.col("host"))), *([prefixes] if longest else []))
    asked = parsed.select("url", "at", slot("at").alias("slot"), F.explode(keys).alias("k")).select("url", "at", "slot", "k.scope", "k.pattern")

    last = F.least(F.coalesce(slot(F.col("valid_to")), F.lit(SLOTS)), slot(F.timestamp_seconds(F.lit(hi))))
    first = F.greatest(slot("valid_from"), F.lit(0))
    open_in = lists.withColumn("slot", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    active = asked.join(open_in, ["scope", "pattern", "slot"]).where((F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
    entry = F.struct("action", "list_name", "scope", "pattern", "valid_from", "valid_to")
    order = F.struct((-_position(F.col("scope"), SCOPES)).alias("s"), (-F.length("pattern")).alias("l"), (-_position(F.col("action"), ACTIONS)).alias("a"), F.coalesce("list_name", F.lit("")).alias("n"))
    ranked = active.groupBy("url", "at").agg(F.min_by(entry, order).alias("e"))
    return ranked.select("url", F.col("at").alias("fetched_at"), F.col("e.action").alias("verdict"), "e.list_name", "e.scope", "e.pattern", "e.valid_from", "e.valid_to")


def filtered(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Every capture with the verdict of its time (``none`` without a valid entry)."""
    found = evaluate(captures, entries, url_col, time_col)
    clash = {c: f"__list_{c}" for c in found.columns}
    renamed = found.select(*[F.col(c).alias(n) for c, n in clash.items()])
    on = F.col(f"`{url_col}`").cast("string").eqNullSafe(F.col(clash["url"])) & F.col(f"`{time_col}`").cast("timestamp").eqNullSafe(F.col(clash["fetched_at"]))
    joined = captures.join(renamed, on, "left")
    added = ("verdict", "list_name", "scope", "pattern", "valid_from", "valid_to")
    facts = [F.coalesce(clash["verdict"], F.lit("none")).alias("verdict"), *[F.col(clash[c]).alias(c) for c in added[1:]]]
    own = []
    for c in captures.columns:
        name = f"capture_{c}" if c in added else c
        while name != c and name in captures.columns:
            name = f"capture_{name}"
        own.append(captures[f"`{c}`"].alias(name))
    return joined.select(*own, *facts)
