"""Reproducible per-row randomness from a key, independent of partitioning.

``Dataframe.sample``/``randomSplit`` draw per partition, so the same row can
land in a different sample after a repartition or an executor retry.  Here a
row's draw is a pure function of (seed, key): md5 once per row, then a cheap
integer mixer for further streams (bootstrap replicates, runs).  Every
step is plain bigint arithmetic, so DuckDB computes the same numbers.  Streams
start from 64 bits of the digest and end in 53-bit uniforms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO32 = 4294967296.0
MASK32 = 0xFFFFFFFF
# Multiplier of a public 32-bit integer finaliser, and the
# golden-ratio increment used to separate streams.
MIX_MULT = 0x45D9F3B
STREAM_STEP = 0x9E3779B1


def key_hash32(key: Column, seed: int | str = 42) -> Column:
    """First 32 bits of md5('<seed>:<key>') as a bigint in [0, 2^32)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_from_hash(h: Column) -> Column:
    return h.cast("double") / F.lit(TWO32)


def key_uniform(key: Column, seed: int | str = 42) -> Column:
    """u in [0, 1) from (seed, key)."""
    return unit_from_hash(key_hash32(key, seed))


def mix32(x: Column) -> Column:
    """Integer finaliser on a value in [0, 2^32); products stay below 2^63."""
    m = F.lit(MASK32)
    x = ((x.bitwiseXOR(F.shiftright(x, 16))) * F.lit(MIX_MULT)).bitwiseAND(m)
    x = ((x.bitwiseXOR(F.shiftright(x, 16))) * F.lit(MIX_MULT)).bitwiseAND(m)
    return x.bitwiseXOR(F.shiftright(x, 16))


def key_hash64(key: Column, seed: int | str = 42) -> Column:
    """The first 64 bits of md5('<seed>:<key>') as a struct of two 32-bit halves (hi, lo)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    return F.struct(half(1).alias("hi"), half(9).alias("lo"))


def with_stream_uniform(df: DataFrame, h: str, stream: Column, out: str) -> DataFrame:
    """``df`` plus ``out``: a further 53-bit uniform for ``stream`` (1, 2, ...) of the row's ``key_hash64`` column ``h``.

    Three Feistel rounds keyed by the stream: for one stream the map of 64-bit
    hashes is one to one, and streams are not shifts of each other.  Each round
    is a projection of its own, so its result is computed once and not copied
    into every use.
    """
    def keyed(x: Column, r: int) -> Column:
        return mix32((x + (stream.cast("bigint") * 4 + r) * F.lit(STREAM_STEP)).bitwiseAND(F.lit(MASK32)))

    a, b, c = f"{out}__a", f"{out}__b", f"{out}__c"
    df = df.withColumn(a, F.col(h)["hi"].bitwiseXOR(keyed(F.col(h)["lo"], 1)))
    df = df.withColumn(b, F.col(h)["lo"].bitwiseXOR(keyed(F.col(a), 2)))
    df = df.withColumn(c, F.col(a).bitwiseXOR(keyed(F.col(b), 3)))
    u = (F.col(c) * F.lit(1 << 21) + F.shiftright(F.col(b), 11)).cast("double") / F.lit(float(1 << 53))
    return df.withColumn(out, u).drop(a, b, c)


def poisson1_cdf() -> list[float]:
    """Cumulative P(X <= k) of Poisson(1) for k = 0, 1, ... until the tail is below 2^-53."""
    out, acc, term, k = [], 0.0, math.exp(-1.0), 0
    while not out or out[-1] < 1.0 - 2.0 ** -53:
        acc = min(acc + term, 1.0)
        if out and acc <= out[-1]:
            break
        out.append(acc)
        k += 1
        term /= k
    return out


def poisson1_weight(u: Column) -> Column:
    """Inverse-CDF Poisson(1) draw from a 53-bit uniform; the table reaches as far as such a uniform can."""
    cdf = poisson1_cdf()
    expr = F.lit(len(cdf))
    for k, c in reversed(list(enumerate(cdf))):
        expr = F.when(u < F.lit(c), F.lit(k)).otherwise(expr)
    return expr


def salt(key_cols: list[Column], buckets: int) -> Column:
    """Deterministic salt in [0, buckets) for spreading a hot join key."""
    return F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int")
