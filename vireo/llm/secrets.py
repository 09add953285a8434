"""Operator 7: secret scan.

Base rules (assignments, access keys, long hex runs) are regular expressions
over the whole text.  A randomness battery adds spans: every long run of key
characters outside the base spans gets an inferred encoding, and three tests
measure how well it fits a random draw of that alphabet:

* chi-squared uniformity over the alphabet,
* a runs test (runs above and below the alphabet's middle),
* lag-1 serial correlation of the symbol values.

Each test gives a p-value under the hypothesis *random*; a candidate fits it
when Fisher's combination stays above ``FIT``.  Its p-value under the
hypothesis *written* comes from the corpus itself: all runs too short for the
battery are counted by symbol and by pair of neighbours, which gives each
alphabet a first-order law of written runs.  The ratio of the written to the
random probability of a run bounds its p-value (a likelihood ratio has mean
one, so it passes t with a chance of at most 1 / t) at any length, so short
runs, and words glued to numbers, can't reach a small one.  A
Benjamini-Hochberg threshold per (encoding, length class), over all tested
runs of the whole table, bounds the share of false discoveries.  A run that
fits no encoding is tested again in its pieces of letters and digits.
Letter-only and digit-only runs are tested like all others.  Symbol counts and
p-values meet in tables of bounded size; no text is shuffled.

Defined cases: null text is empty; an empty text has no spans; repeated rows
each get their own result; a null id stays null; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import stored, text_buffers, text_cuts

# The base rules. Runs are maximal, so a lower bound on the length equals dropping the short ones.
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
MIN_SECRET = 8

#: Shortest run that the battery looks at, smallest p-value that counts as random, and the false-discovery rate.
MIN_RUN, FIT, FDR = 20, 1e-4, 0.01
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RUN)
#: p-values of the hypothesis "written text" are kept as whole steps of -log10(p) * BINS_PER_DECADE.
BINS_PER_DECADE, MAX_BIN, UNFIT = 4, 80, -1
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)

# Alphabets in the order of their symbol values.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "UPPER": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {k: frozenset(v) for k, v in ALPHABETS.items()}
_RANK = {k: {c: i for i, c in enumerate(v)} for k, v in ALPHABETS.items()}
#: Sum of (q - 1/A)^2 over an alphabet of A symbols for written words: about .065 - 1/A, letters holding all mass.
#: ``battery`` uses it where no law of the corpus is given.
WRITTEN_MASS = 0.065
_PIECE = re.compile(r"[A-Za-z0-9]{%d,}" % MIN_RUN)
_KEY_BYTES = np.zeros(256, dtype=bool)
_KEY_BYTES[[ord(c) for c in _UPPER + _LOWER + _DIGITS + "+/_-"]] = True


def _normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _chi2_sf(x: float, k: float) -> float:
    """Upper tail of chi-squared by the cube-root normal approximation (Wilson-Hilferty)."""
    if x <= 0:
        return 1.0
    return _normal_sf(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


def infer_encoding(run: str) -> str | None:
    """The smallest alphabet that holds the run; None where it lacks digits or is a plain number."""
    body = run.rstrip("=")
    symbols = set(body)
    if not symbols & _SETS["decimal"] or not symbols - _SETS["decimal"]:
        return None
    return next((k for k, s in _SETS.items() if symbols <= s), None)


def smallest_alphabet(run: str) -> str | None:
    """The smallest alphabet that holds the run, letter-only and digit-only ones included."""
    symbols = set(run.rstrip("="))
    return next((k for k, s in _SETS.items() if symbols <= s), None)


class WrittenLaw:
    """First-order law of written runs in each alphabet, against uniform draws, from counts of symbols and neighbours."""

    def __init__(self, symbols: np.ndarray, pairs: np.ndarray):
        self.first, self.next = {}, {}
        for name, alphabet in ALPHABETS.items():
            at = [ord(c) for c in alphabet]
            a = len(at)
            seen = symbols[at] + 1.0
            q = seen / seen.sum()
            moved = pairs[np.ix_(at, at)]
            # as many pseudo-counts as symbols, in the proportions of the symbols
            to = (moved + a * q) / (moved.sum(axis=1, keepdims=True) + a)
            self.first[name], self.next[name] = np.log10(q * a), np.log10(to * a)

    def log10_p(self, values: np.ndarray, encoding: str) -> float:
        """log10 of the bound on the p-value of "written"."""
        return min(0.0, float(self.first[encoding][values[0]] + self.next[encoding][values[:-1], values[1:]].sum()))


def symbol_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and neighbouring pairs in all runs of key characters shorter than ``MIN_RUN``."""
    everything, offsets = text_buffers(column)
    symbols, pairs = np.zeros(128, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
    for lo, hi in text_cuts(everything, 1 << 20):
        raw = everything[lo:hi]
        key = _KEY_BYTES[raw]
        opens = key.copy()
        opens[1:] &= ~key[:-1]
        texts = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        opens[texts] = key[texts]
        at = np.flatnonzero(key)
        if not len(at):
            continue
        run = np.cumsum(opens)[at] - 1
        at = at[(np.bincount(run) < MIN_RUN)[run]]
        follows = at[~opens[at]]
        symbols += np.bincount(raw[at], minlength=128)
        pairs += np.bincount(raw[follows - 1].astype(np.int64) << 7 | raw[follows], minlength=1 << 14)
    return symbols, pairs.reshape(128, 128)


def written_law(docs: DataFrame, text_col: str) -> WrittenLaw:
    """The law from every text; the driver gets at most one row a symbol and pair of symbols."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(128 + (1 << 14), dtype=np.int64)
        for batch in batches:
            symbols, pairs = symbol_counts(batch.column("text"))
            total += np.concatenate([symbols, pairs.ravel()])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["i", "n"])

    found = np.zeros(128 + (1 << 14))
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    for r in texts.mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        found[r["i"]] = r["n"]
    return WrittenLaw(found[:128], found[128:].reshape(128, 128))


def battery(run: str, encoding: str, law: WrittenLaw | None = None) -> tuple[float, float]:
    """(Fisher's p of "random", p of "written") for one run."""
    rank = _RANK[encoding]
    values = np.array([rank[c] for c in run.rstrip("=")])
    n, a = len(values), len(rank)
    counts = np.bincount(values, minlength=a)
    statistic = float(((counts - n / a) ** 2).sum() / (n / a))
    # two-sided: a run that fills its alphabet too evenly (a counter, an alphabet) isn't random either
    upper = _chi2_sf(statistic, a - 1)
    p_chi = min(1.0, 2 * min(upper, 1 - upper))
    above = values >= a / 2
    n1 = int(above.sum())
    n0 = n - n1
    if n1 and n0:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * n1 * n0 / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p_runs = 2 * _normal_sf(abs(runs - mean) / math.sqrt(var))
    else:
        p_runs = 2.0 ** (1 - n)
    centred = values - values.mean()
    power = float((centred ** 2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    p_serial = 2 * _normal_sf(abs(serial + 1 / n) * math.sqrt(n))
    logs = -2 * sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    p_random = _chi2_sf(logs, 6)
    if law is not None:
        return p_random, max(10 ** law.log10_p(values, encoding), 1e-30)
    # Patnaik: the noncentral law as a scaled central one
    extra = n * a * max(WRITTEN_MASS - 1 / a, 0.01)
    k = a - 1
    scale, freedom = (k + 2 * extra) / (k + extra), (k + extra) ** 2 / (k + 2 * extra)
    p_written = 1 - _chi2_sf(statistic / scale, freedom)
    return p_random, max(p_written, 1e-30)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) of the base rules, in result order."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_SECRET]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found)


def open_runs(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of runs that lie outside the base spans and are long enough."""
    for m in RUN.finditer(text):
        s, e = m.span()
        for a, b, _ in taken:
            if a < e and s < b:
                if a - s >= MIN_RUN:
                    yield s, a
                s = max(s, b)
        if e - s >= MIN_RUN:
            yield s, e


def candidates(text: str, taken: list[tuple[int, int, int]], law: WrittenLaw) -> list[tuple[int, int, str, int]]:
    """Tested runs outside the base spans: (start, end, stratum, bin); the bin is ``UNFIT`` where a run doesn't fit "random"."""
    out = []

    def tested(s: int, e: int) -> bool:
        run = text[s:e]
        encoding = smallest_alphabet(run)
        # after padding is cut a run may be too short for the tests
        if encoding is None or len(run.rstrip("=")) < MIN_RUN - 2:
            return False
        p_random, p_written = battery(run, encoding, law)
        length = max(x for x in LENGTH_CLASSES if x <= e - s)
        fits = p_random >= FIT
        out.append((s, e, f"{encoding}:{length}", min(MAX_BIN, int(-math.log10(p_written) * BINS_PER_DECADE)) if fits else UNFIT))
        return fits

    for s, e in open_runs(text, taken):
        if not tested(s, e):
            for m in _PIECE.finditer(text, s, e):
                if m.span() != (s, e):
                    tested(*m.span())
    return out


_SCAN = "base array<struct<s:int,e:int,k:int>>, runs array<struct<s:int,e:int,stratum:string,bin:int>>"


def _scan_batches(batches: Iterator[pa.RecordBatch], law: WrittenLaw) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32())]))
    run = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("stratum", pa.string()), ("bin", pa.int32())]))
    for batch in batches:
        base, runs = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            found = base_spans(text)
            base.append([{"s": s, "e": e, "k": k} for s, e, k in found])
            runs.append([{"s": s, "e": e, "stratum": t, "bin": b} for s, e, t, b in candidates(text, found, law)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(runs, run)], ["id", "base", "runs"])


def discovery_bins(histogram: list[tuple[str, int, int]], rate: float = FDR) -> dict[str, int]:
    """Per stratum, the smallest bin that Benjamini-Hochberg accepts; p-values count at their bin's upper edge, unfit runs in the total."""
    by: dict[str, dict[int, int]] = {}
    for stratum, b, n in histogram:
        by.setdefault(stratum, {})[b] = n
    out = {}
    for stratum, bins in by.items():
        total, seen = sum(bins.values()), 0
        for b in sorted((b for b in bins if b > UNFIT), reverse=True):
            seen += bins[b]
            if 10 ** (-b / BINS_PER_DECADE) <= rate * seen / total:
                out[stratum] = b
    return out


def _limits(histogram: DataFrame, rate: float) -> dict[str, int]:
    """``discovery_bins`` of candidate runs; the histogram is bounded: encodings x length classes x bins."""
    counted = histogram.select(F.explode("runs").alias("r")).groupBy("r.stratum", "r.bin").count().collect()
    return discovery_bins([(r["stratum"], r["bin"], r["count"]) for r in counted], rate)


def _scanned(docs: DataFrame, id_col: str, text_col: str, law: WrittenLaw) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lambda batches: _scan_batches(batches, law), f"id {id_type}, {_SCAN}"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FDR) -> DataFrame:
    """One row per input row: ``id_col`` and ``spans`` array<struct<s, e, k>> in (start, kind) order."""
    scanned = stored(_scanned(docs, id_col, text_col, written_law(docs, text_col)), "secret-scan")
    least = _limits(scanned, rate)
    if least:
        limits = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv])
        accepted = F.filter("runs", lambda r: F.coalesce(limits[r["stratum"]] <= r["bin"], F.lit(False)))
    else:
        accepted = F.filter("runs", lambda r: F.lit(False))
    added = F.transform(accepted, lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"), F.lit(KINDS.index("random")).alias("k")))
    return scanned.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", added)).alias("spans"))


def span_text(spans, only_base: bool = False):
    """kind:start:end, comma-joined (a column)."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda x: x["k"] < 3) if only_base else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns from ``find_secrets``."""
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")
    return find_secrets(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(spans, True).cast("binary"), 256).alias("base_sha256"), span_text(spans).alias("spans"),
        count(3).alias("n_random"))


def mask(text: str, spans: list[tuple[int, int]], by: str = "[SECRET]") -> str:
    """``text`` with every span replaced; overlapping spans merge."""
    out, at = [], 0
    for s, e in sorted(spans):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], by]
        at = e
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text", rate: float = FDR) -> DataFrame:
    """``docs`` with every found secret in ``text_col`` replaced by ``[SECRET]``; all rows and columns stay.

    One pass counts symbols, one gathers the bounded histogram behind the discovery limits; a
    third scans again and replaces in place, so no text is shuffled.
    """
    numbered = docs.select(F.lit(0).alias("n"), text_col)
    law = written_law(docs, text_col)
    least = _limits(_scanned(numbered, "n", text_col, law), rate)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            out = []
            for value in batch.column(at):
                text = value.as_py()
                if text:
                    found = base_spans(text)
                    more = [(s, e) for s, e, stratum, b in candidates(text, found, law) if b >= least.get(stratum, MAX_BIN + 1)]
                    if found or more:
                        text = mask(text, [x[:2] for x in found] + more)
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(masked, docs.schema)
