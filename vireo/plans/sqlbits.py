"""SQL fragments for the DuckDB twins of the Spark queries.

These mirror the Spark expressions in ``vireo.functions.text`` using DuckDB
functions (RE2 regexes, ``string_split_regex``); they are only used to build
the oracle strings.
"""

from __future__ import annotations

from vireo.functions.text import NUMERIC_FEATURES, PY_WHITESPACE_CLASS, PY_WHITESPACE_RUN

NL2 = "chr(10) || chr(10)"


def _py_tokens(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{PY_WHITESPACE_RUN}'), lambda w: length(w) > 0)"


def _non_ws() -> str:
    return PY_WHITESPACE_CLASS[0] + "^" + PY_WHITESPACE_CLASS[1:]


def features_sql(text: str, summary: str, mode: str = "ref") -> list[str]:
    """``<expr> AS <name>`` for the 13 features, in NUMERIC_FEATURES order."""
    if mode == "ref":
        t, s = f"coalesce({text}, '')", f"coalesce({summary}, '')"
        cc = f"length({t})"
        wc = f"len(string_split_regex({t}, '\\s+'))"
        sl = f"length({s})"
        e = {
            "char_count": f"CAST({cc} AS DOUBLE)",
            "word_count": f"CAST({wc} AS DOUBLE)",
            "sentence_count": f"CAST(len(string_split_regex({t}, '[.!?]+')) AS DOUBLE)",
            "avg_word_length": f"CASE WHEN {wc} > 0 THEN {cc} / {wc} ELSE 0.0 END",
            "unique_word_ratio": f"CASE WHEN {wc} > 0 THEN len(list_distinct(string_split({t}, ' '))) / {wc} ELSE 0.0 END",
            "question_count": f"CAST({cc} - length(replace({t}, '?', '')) AS DOUBLE)",
            "exclamation_count": f"CAST({cc} - length(replace({t}, '!', '')) AS DOUBLE)",
            "uppercase_ratio": f"CASE WHEN {cc} > 0 THEN length(regexp_replace({t}, '[^A-Z]', '', 'g')) / {cc} ELSE 0.0 END",
            "has_url": f"CAST(CASE WHEN regexp_matches({t}, 'https?://\\S+') THEN 1.0 ELSE 0.0 END AS DOUBLE)",
            "paragraph_count": f"CAST(len(string_split({t}, {NL2})) AS DOUBLE)",
            "summary_length": f"CAST({sl} AS DOUBLE)",
            "summary_word_count": f"CAST(len(string_split_regex({s}, '\\s+')) AS DOUBLE)",
            "content_density": f"CASE WHEN {cc} > 0 THEN {sl} / {cc} ELSE 0.0 END",
        }
    elif mode == "script":
        t, s = text, summary
        cc = f"length({t})"
        wc = f"len(string_split_regex({t}, '\\s+'))"
        sent = f"(len(string_split_regex({t}, '[.!?]+')) - 1)"
        low = _py_tokens(f"lower({t})")
        up = f"length(regexp_replace({t}, '\\P{{Lu}}', '', 'g'))"
        e = {
            "char_count": f"CAST({cc} AS DOUBLE)",
            "word_count": f"CAST({wc} AS DOUBLE)",
            "sentence_count": f"CAST(CASE WHEN {sent} < 1 THEN 1 ELSE {sent} END AS DOUBLE)",
            "avg_word_length": f"{cc} / CAST(CASE WHEN {wc} > 0 THEN {wc} ELSE 1 END AS DOUBLE)",
            "unique_word_ratio": (f"CASE WHEN length({t}) > 0 THEN len(list_distinct({low})) / "
                                  f"CAST(CASE WHEN len({low}) > 0 THEN len({low}) ELSE 1 END AS DOUBLE) ELSE 0.0 END"),
            "question_count": f"CAST(len(string_split_regex({t}, '\\?')) - 1 AS DOUBLE)",
            "exclamation_count": f"CAST(len(string_split_regex({t}, '!')) - 1 AS DOUBLE)",
            "uppercase_ratio": f"CASE WHEN length({t}) > 0 THEN {up} / length({t}) ELSE 0.0 END",
            "has_url": f"CAST(CASE WHEN contains({t}, 'http') THEN 1.0 ELSE 0.0 END AS DOUBLE)",
            "paragraph_count": f"CAST(len(string_split({t}, {NL2})) AS DOUBLE)",
            "summary_length": f"CAST(length({s}) AS DOUBLE)",
            "summary_word_count": f"CAST(len(string_split_regex({s}, '\\s+')) AS DOUBLE)",
            "content_density": f"length({s}) / CAST(CASE WHEN {cc} > 0 THEN {cc} ELSE 1 END AS DOUBLE)",
        }
        e = {k: f"coalesce({v}, 0.0)" for k, v in e.items()}
    elif mode == "notebook":
        t, s = f"coalesce({text}, '')", f"coalesce({summary}, '')"
        toks = _py_tokens(t)
        wc = f"len({toks})"
        cc = f"length({t})"
        den = f"CAST(CASE WHEN {cc} > 0 THEN {cc} ELSE 1 END AS DOUBLE)"
        wden = f"CAST(CASE WHEN {wc} > 0 THEN {wc} ELSE 1 END AS DOUBLE)"
        e = {
            "char_count": f"CAST({cc} AS DOUBLE)",
            "word_count": f"CAST({wc} AS DOUBLE)",
            "sentence_count": f"CAST(len(regexp_extract_all({t}, '[.!?]+')) AS DOUBLE)",
            "avg_word_length": f"{cc} / {wden}",
            "unique_word_ratio": f"len(list_distinct(list_transform({toks}, lambda w: lower(w)))) / {wden}",
            "question_count": f"CAST({cc} - length(replace({t}, '?', '')) AS DOUBLE)",
            "exclamation_count": f"CAST({cc} - length(replace({t}, '!', '')) AS DOUBLE)",
            "uppercase_ratio": f"length(regexp_replace({t}, '[^A-Z]', '', 'g')) / {den}",
            "has_url": f"CAST(CASE WHEN regexp_matches({t}, 'https?://') THEN 1.0 ELSE 0.0 END AS DOUBLE)",
            "paragraph_count": f"CAST(len(regexp_extract_all({t}, {NL2})) + 1 AS DOUBLE)",
            "summary_length": f"CAST(length({s}) AS DOUBLE)",
            "summary_word_count": f"CAST(len({_py_tokens(s)}) AS DOUBLE)",
            "content_density": f"length({s}) / {den}",
        }
    else:
        t, s = f"coalesce({text}, '')", f"coalesce({summary}, '')"
        toks = _py_tokens(t)
        wc = f"len({toks})"
        cc = f"length({t})"
        tok_chars = f"list_sum(list_transform({toks}, lambda w: length(w)))"
        nb = f"len(list_filter(string_split_regex({t}, '[.!?]+'), lambda p: regexp_matches(p, '{_non_ws()}')))"
        den = f"CAST(CASE WHEN {cc} > 0 THEN {cc} ELSE 1 END AS DOUBLE)"
        e = {
            "char_count": f"CAST({cc} AS DOUBLE)",
            "word_count": f"CAST({wc} AS DOUBLE)",
            "sentence_count": f"CAST(greatest({nb}, 1) AS DOUBLE)",
            "avg_word_length": f"CASE WHEN {wc} > 0 THEN {tok_chars} / {wc} ELSE 0.0 END",
            "unique_word_ratio": (f"len(list_distinct(list_transform({toks}, lambda w: lower(w)))) / "
                                  f"CAST(CASE WHEN {wc} > 0 THEN {wc} ELSE 1 END AS DOUBLE)"),
            "question_count": f"CAST({cc} - length(replace({t}, '?', '')) AS DOUBLE)",
            "exclamation_count": f"CAST({cc} - length(replace({t}, '!', '')) AS DOUBLE)",
            "uppercase_ratio": f"length(regexp_replace({t}, '\\P{{Lu}}', '', 'g')) / {den}",
            "has_url": f"CAST(CASE WHEN contains({t}, 'http') THEN 1.0 ELSE 0.0 END AS DOUBLE)",
            "paragraph_count": f"CAST(len(string_split({t}, {NL2})) AS DOUBLE)",
            "summary_length": f"CAST(length({s}) AS DOUBLE)",
            "summary_word_count": f"CAST(len({_py_tokens(s)}) AS DOUBLE)",
            "content_density": f"length({s}) / {den}",
        }
    return [f"{e[n]} AS {n}" for n in NUMERIC_FEATURES]


def rnd(expr: str, dp: int = 6) -> str:
    return f"round({expr}, {dp})"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def u32(key_sql: str, seed: int | str = 42) -> str:
    """DuckDB twin of ``key_hash32``: first 32 bits of md5('<seed>:<key>')."""
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"


def unit(h: str) -> str:
    return f"(CAST({h} AS DOUBLE) / 4294967296.0)"


def mix32(x: str) -> str:
    a = f"((xor({x}, ({x} >> 16)) * 73244475) & 4294967295)"
    b = f"((xor({a}, ({a} >> 16)) * 73244475) & 4294967295)"
    return f"xor({b}, ({b} >> 16))"


def u64(key_sql: str, seed: int | str = 42) -> tuple[str, str]:
    """DuckDB twin of ``key_hash64``: the two 32-bit halves."""
    half = f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), %d, 8)) AS BIGINT)"
    return half % 1, half % 9


def stream_columns(rows: str, stream: str, keep: str) -> str:
    """DuckDB twin of ``with_stream_uniform`` over ``rows`` with hi, lo: selects ``keep`` and ``u``."""
    def keyed(x: str, r: int) -> str:
        return mix32(f"(({x} + (CAST({stream} AS BIGINT) * 4 + {r}) * 2654435761) & 4294967295)")

    return (f"(SELECT {keep}, CAST(c * 2097152 + (b >> 11) AS DOUBLE) / 9007199254740992.0 AS u FROM "
            f"(SELECT *, xor(a, {keyed('b', 3)}) AS c FROM (SELECT *, xor(lo, {keyed('a', 2)}) AS b FROM "
            f"(SELECT *, xor(hi, {keyed('lo', 1)}) AS a FROM {rows}))))")
