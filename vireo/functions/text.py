"""Column expressions for the 13 hand-made text features.

All are JVM built-ins (split/size/length/regexp), without lambdas, so a
feature projection stays inside whole-stage codegen and never starts a
Python worker.  Four modes reproduce the published variants:

``ref``    -- the pipeline transformer (features computed on the text with
              nulls filled by '' first; regex ``\\s+`` split keeps edge blanks).
``script`` -- the batch script: ``size(split)-1`` counters, a Unicode
              upper-case ratio and a lower-cased whitespace-token ratio
              (the original ran these two as Python UDFs), nulls to 0.0.
``words``  -- the pandas variant: Python ``str.split()`` tokens, true mean
              word length, non-blank sentence pieces.
``notebook`` -- the comparison notebook's pandas variant: runs of sentence
              marks, blank-line count + 1, ASCII upper case, URL prefix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` accepts, written as a
# regex class usable by both Java regex and RE2 (``\x{..}`` escapes).
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
PY_WHITESPACE_RUN = PY_WHITESPACE_CLASS + "+"
# the same characters as a plain string, for ``btrim`` (linear, unlike an edge regex)
PY_WHITESPACE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                        0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Patterns of the reference features.
WORD_SPLIT = r"\s+"
SENTENCE_SPLIT = r"[.!?]+"
PARAGRAPH_SPLIT = "\n\n"
URL_PATTERN = r"https?://\S+"
EDA_URL_PATTERN = r"https?://"

# The reference's feature names, in its order.
NUMERIC_FEATURES = [
    "char_count", "word_count", "sentence_count", "avg_word_length",
    "unique_word_ratio", "question_count", "exclamation_count",
    "uppercase_ratio", "has_url", "paragraph_count",
    "summary_length", "summary_word_count", "content_density",
]

MODES = ("ref", "script", "words", "notebook")


def _d(c: Column) -> Column:
    return c.cast("double")


def char_count(t: Column) -> Column:
    return F.length(t)


def split_count(t: Column, pattern: str) -> Column:
    """Pieces of a regex split, keeping empty edges (Java split, limit -1)."""
    return F.size(F.split(t, pattern))


def char_occurrences(t: Column, ch: str) -> Column:
    """Occurrences of one literal character: length minus length without it."""
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


def ascii_upper_count(t: Column) -> Column:
    return F.length(F.regexp_replace(t, "[^A-Z]", ""))


def unicode_upper_count(t: Column) -> Column:
    # Java's binary Uppercase property: what Python's per-char isupper() tests.
    return F.length(F.regexp_replace(t, r"\P{IsUppercase}", ""))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den > 0, _d(num) / _d(den)).otherwise(F.lit(0.0))


def ratio_den_floor1(num: Column, den: Column) -> Column:
    """num / den with den replaced by 1 when it is not positive."""
    return _d(num) / _d(F.when(den > 0, den).otherwise(F.lit(1)))


# Between sentence marks, a piece holds ink exactly if it isn't empty once the
# white space is deleted: counting runs of the remaining text is linear.
INK_PIECE = "[^.!?]+"


def _trimmed(t: Column) -> Column:
    """``t`` without white space at its edges."""
    return F.btrim(t, F.lit(PY_WHITESPACE_CHARS))


def _py_split(trimmed: Column) -> Column:
    """``str.split()`` of an already edge-trimmed string, without a lambda."""
    empty = F.array().cast("array<string>")
    return F.when(trimmed == "", empty).otherwise(F.split(trimmed, PY_WHITESPACE_RUN))


def feature_stages(text: Column, summary: Column, mode: str = "ref") -> list[dict[str, Column]]:
    """The 13 features of ``mode`` as successive projections.

    Every costly intermediate (a regex split, a distinct count) is computed
    once in an inner projection and referenced by name in the next one;
    Catalyst does not collapse projections that would duplicate such work.
    The last stage maps feature name -> double expression.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    c = F.col
    if mode == "ref":
        t = F.coalesce(text, F.lit(""))
        s = F.coalesce(summary, F.lit(""))
        base = {
            "__cc": char_count(t), "__wc": split_count(t, WORD_SPLIT),
            "__sc": split_count(t, SENTENCE_SPLIT), "__uw": F.size(F.array_distinct(F.split(t, " "))),
            "__q": char_occurrences(t, "?"), "__e": char_occurrences(t, "!"),
            "__up": ascii_upper_count(t), "__url": t.rlike(URL_PATTERN),
            "__pc": split_count(t, PARAGRAPH_SPLIT), "__sl": F.length(s),
            "__swc": split_count(s, WORD_SPLIT),
        }
        final = {
            "char_count": _d(c("__cc")), "word_count": _d(c("__wc")),
            "sentence_count": _d(c("__sc")),
            "avg_word_length": ratio_or_zero(c("__cc"), c("__wc")),
            "unique_word_ratio": ratio_or_zero(c("__uw"), c("__wc")),
            "question_count": _d(c("__q")), "exclamation_count": _d(c("__e")),
            "uppercase_ratio": ratio_or_zero(c("__up"), c("__cc")),
            "has_url": F.when(c("__url"), 1.0).otherwise(0.0),
            "paragraph_count": _d(c("__pc")), "summary_length": _d(c("__sl")),
            "summary_word_count": _d(c("__swc")),
            "content_density": ratio_or_zero(c("__sl"), c("__cc")),
        }
        return [base, final]
    if mode == "script":
        t, s = text, summary
        pre = {"__low": _trimmed(F.lower(t))}
        base = {
            "__cc": char_count(t), "__wc": split_count(t, WORD_SPLIT),
            "__sent": split_count(t, SENTENCE_SPLIT) - 1,
            "__ltoks": _py_split(c("__low")),
            "__q": char_occurrences(t, "?"), "__e": char_occurrences(t, "!"),
            "__up": unicode_upper_count(t), "__url": t.contains("http"),
            "__pc": split_count(t, PARAGRAPH_SPLIT), "__sl": F.length(s),
            "__swc": split_count(s, WORD_SPLIT),
        }
        counts = {"__ntok": F.size(c("__ltoks")), "__nuniq": F.size(F.array_distinct(c("__ltoks")))}
        final = {
            "char_count": _d(c("__cc")), "word_count": _d(c("__wc")),
            "sentence_count": _d(F.when(c("__sent") < 1, F.lit(1)).otherwise(c("__sent"))),
            "avg_word_length": ratio_den_floor1(c("__cc"), c("__wc")),
            # "if not text: 0.0" -> empty text gives 0; else distinct/max(n,1)
            "unique_word_ratio": F.when(c("__cc") > 0, ratio_den_floor1(c("__nuniq"), c("__ntok")))
                                  .otherwise(F.lit(0.0)),
            "question_count": _d(c("__q")), "exclamation_count": _d(c("__e")),
            "uppercase_ratio": F.when(c("__cc") > 0, _d(c("__up")) / _d(c("__cc"))).otherwise(F.lit(0.0)),
            "has_url": F.when(c("__url"), 1.0).otherwise(0.0),
            "paragraph_count": _d(c("__pc")), "summary_length": _d(c("__sl")),
            "summary_word_count": _d(c("__swc")),
            "content_density": ratio_den_floor1(c("__sl"), c("__cc")),
        }
        final = {k: F.coalesce(v, F.lit(0.0)) for k, v in final.items()}
        return [pre, base, counts, final]
    if mode == "notebook":
        t = F.coalesce(text, F.lit(""))
        s = F.coalesce(summary, F.lit(""))
        pre = {"__trim": _trimmed(t),
               "__strim": _trimmed(s)}
        base = {
            "__cc": char_count(t), "__toks": _py_split(c("__trim")),
            "__ltoks": _py_split(F.lower(c("__trim"))),
            "__sent": F.regexp_count(t, F.lit(SENTENCE_SPLIT)),
            "__q": char_occurrences(t, "?"), "__e": char_occurrences(t, "!"),
            "__up": ascii_upper_count(t), "__url": t.rlike(EDA_URL_PATTERN),
            "__pc": F.regexp_count(t, F.lit(PARAGRAPH_SPLIT)) + 1, "__sl": F.length(s),
            "__swc": F.size(_py_split(c("__strim"))),
        }
        counts = {"__wc": F.size(c("__toks")), "__nuniq": F.size(F.array_distinct(c("__ltoks")))}
        final = {
            "char_count": _d(c("__cc")), "word_count": _d(c("__wc")),
            "sentence_count": _d(c("__sent")),
            "avg_word_length": ratio_den_floor1(c("__cc"), c("__wc")),
            "unique_word_ratio": ratio_den_floor1(c("__nuniq"), c("__wc")),
            "question_count": _d(c("__q")), "exclamation_count": _d(c("__e")),
            "uppercase_ratio": ratio_den_floor1(c("__up"), c("__cc")),
            "has_url": F.when(c("__url"), 1.0).otherwise(0.0),
            "paragraph_count": _d(c("__pc")), "summary_length": _d(c("__sl")),
            "summary_word_count": _d(c("__swc")),
            "content_density": ratio_den_floor1(c("__sl"), c("__cc")),
        }
        return [pre, base, counts, final]
    # words
    t = F.coalesce(text, F.lit(""))
    s = F.coalesce(summary, F.lit(""))
    pre = {"__trim": _trimmed(t),
           "__strim": _trimmed(s), "__inked": F.regexp_replace(t, PY_WHITESPACE_CLASS, "")}
    base = {
        "__cc": char_count(t),
        "__toks": _py_split(c("__trim")),
        "__ltoks": _py_split(F.lower(c("__trim"))),
        "__ink": F.length(c("__inked")),
        "__sent": F.regexp_count(c("__inked"), F.lit(INK_PIECE)),
        "__q": char_occurrences(t, "?"), "__e": char_occurrences(t, "!"),
        "__up": unicode_upper_count(t), "__url": t.contains("http"),
        "__pc": split_count(t, PARAGRAPH_SPLIT), "__sl": F.length(s),
        "__swc": F.size(_py_split(c("__strim"))),
    }
    counts = {"__wc": F.size(c("__toks")), "__nuniq": F.size(F.array_distinct(c("__ltoks")))}
    final = {
        "char_count": _d(c("__cc")), "word_count": _d(c("__wc")),
        "sentence_count": _d(F.greatest(c("__sent"), F.lit(1))),
        "avg_word_length": ratio_or_zero(c("__ink"), c("__wc")),
        "unique_word_ratio": ratio_den_floor1(c("__nuniq"), c("__wc")),
        "question_count": _d(c("__q")), "exclamation_count": _d(c("__e")),
        "uppercase_ratio": ratio_den_floor1(c("__up"), c("__cc")),
        "has_url": F.when(c("__url"), 1.0).otherwise(0.0),
        "paragraph_count": _d(c("__pc")), "summary_length": _d(c("__sl")),
        "summary_word_count": _d(c("__swc")),
        "content_density": ratio_den_floor1(c("__sl"), c("__cc")),
    }
    return [pre, base, counts, final]


def first_line(text: Column) -> Column:
    """A summary stand-in for tables without one: text up to the first newline."""
    return F.substring_index(text, "\n", 1)
