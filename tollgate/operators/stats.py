"""Statistical operators (A18, A19, T1, T2, F2) as grouped Spark aggregates.

Quantiles interpolate linearly between the closest ranks (0.25 of 1..4 is 1.75).
They are picked by rank from one distributed sort, so a group of any size needs no
task that holds its values; ``approx=True`` swaps in ``percentile_approx``.

The bootstrap is a deterministic, hash-driven resampler that draws order
statistics: the middle ranks of a resample come from counts that are split down
a binary tree by coins made from (seed, key, resample) in integer arithmetic, so
another engine can make the same ones.  No draw is made one by one; values are
only looked up at the middle ranks of each resample.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.hashing import md5_bigint
from tollgate.operators.sequence import dense_index, join_null_safe

# Default bootstrap seed and resample count.
BOOTSTRAP_SEED = 20260713
BOOTSTRAP_RESAMPLES = 10_000
# Descriptive quantiles.
QUANTILES = (0.5, 0.25, 0.75, 0.95)


def percentage_delta(reference: Column, treatment: Column) -> Column:
    """``(treatment - reference) / reference * 100``; NULL when reference = 0."""
    return F.when(reference != 0, (treatment - reference) / reference * 100)


def quantiles(df: DataFrame, by: Sequence[str], wanted: Mapping[str, Sequence[float]]) -> DataFrame:
    """Exact quantiles of several columns by rank: the key and, under each column's name, struct(n, q).

    ``n`` counts the values that are not NULL, ``q`` holds one double for each
    wanted probability (NULLs where there is no value).  All columns of all keys
    are sorted once, as rows of (key, column, value), by a range partitioner that
    spreads a hot key over many tasks; only the rows at wanted ranks go on.
    Groups of NULL values only are kept; without keys there is always one row.
    """
    by = list(by)
    names = list(wanted)
    cells = F.array(*[F.struct(F.lit(i).alias("_col"), F.col(c).cast("double").alias("_value")) for i, c in enumerate(names)])
    ranked = dense_index(df.select(*by, F.inline(cells)), [*by, "_col"], [F.col("_value").asc_nulls_last()], name="_rank")
    sizes = ranked.groupBy(*by, "_col").agg(F.count("_value").alias("_n"))
    probs = F.get(F.array(*[F.array(*[F.lit(float(p)) for p in wanted[c]]) for c in names]), F.col("_col"))
    top = F.greatest(F.col("_n") - 1, F.lit(0))
    is_wanted = F.exists(probs, lambda p: (F.floor(p * top) == F.col("_rank")) | (F.ceil(p * top) == F.col("_rank")))
    picked = join_null_safe(ranked, sizes, [*by, "_col"]).where(is_wanted)
    parts = []
    for i, c in enumerate(names):
        here = F.col("_col") == i
        at = lambda rank: F.max(F.when(here & (F.col("_rank") == rank), F.col("_value")))  # noqa: B023, E731
        parts.append(F.coalesce(F.max(F.when(here, F.col("_n"))), F.lit(0)).alias(f"_n{i}"))
        parts.append(F.array(*[F.struct(F.max(F.when(here, p * top)).alias("at"), at(F.floor(p * top)).alias("lo"), at(F.ceil(p * top)).alias("hi"))
                               for p in map(float, wanted[c])]).alias(f"_q{i}"))
    line = lambda x: F.when(x["lo"] == x["hi"], x["lo"]).otherwise(
        (F.ceil(x["at"]) - x["at"]) * x["lo"] + (x["at"] - F.floor(x["at"])) * x["hi"])
    return picked.groupBy(*by).agg(*parts).select(
        *by, *[F.struct(F.col(f"_n{i}").alias("n"), F.transform(f"_q{i}", line).alias("q")).alias(c) for i, c in enumerate(names)])


def descriptive(df: DataFrame, by: Sequence[str], value: str, prefix: str = "",
                approx: bool = False) -> DataFrame:
    """N, median, q1, q3, iqr, p95 per group (NULLs ignored)."""
    if approx:
        arr = F.array(*[F.lit(p) for p in QUANTILES])
        agg = df.groupBy(*by).agg(F.count(value).alias("_n"), F.percentile_approx(F.col(value), arr, 10_000).alias("_q"))
    else:
        agg = quantiles(df, by, {value: QUANTILES}).select(*by, F.col(value)["n"].alias("_n"), F.col(value)["q"].alias("_q"))
    return agg.select(*by, *quantile_columns(F.col("_n"), F.col("_q"), prefix))


def quantile_columns(n: Column, q: Column, prefix: str) -> list[Column]:
    """n, median, q1, q3, iqr, p95 from an array of ``QUANTILES``."""
    return [n.alias(f"{prefix}n"), q[0].alias(f"{prefix}median"), q[1].alias(f"{prefix}q1"), q[2].alias(f"{prefix}q3"),
            (q[2] - q[1]).alias(f"{prefix}iqr"), q[3].alias(f"{prefix}p95")]


# A resample's draws are points of [0, 1), given by so many binary digits.
DIGITS = 32
# Coins taken from one hash, and hashes that a task holds at once.
COINS, BLOCK = 31, 1 << 21
_WORD = np.uint64((1 << 32) - 1)


def scrambled(x: np.ndarray) -> np.ndarray:
    """32 bits (in 64) through two multiply-xorshift rounds; products stay below 2**63."""
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x45D9F3B)) & _WORD
    return x ^ (x >> np.uint64(16))


def _heads(a: np.ndarray, high: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many of ``m`` coins fall left: bits of hashes of (a, high, 0), (a, high, 1), ..."""
    out = np.zeros(len(m), np.int64)
    sizes = (m + (COINS - 1)) // COINS
    single = sizes == 1
    coins = scrambled(a[single] ^ high[single]) & ((np.uint64(1) << m[single].astype(np.uint64)) - np.uint64(1))
    out[single] = np.bitwise_count(coins)
    rows = np.flatnonzero(sizes > 1)
    # Blocks of whole rows; a row that is longer than a block goes through it in pieces.
    block = np.cumsum(sizes[rows]) // BLOCK
    for part in np.split(rows, np.flatnonzero(np.diff(block)) + 1) if len(rows) else ():
        longest = int(sizes[part].max())
        for first in range(0, longest, BLOCK):
            here = np.clip(sizes[part] - first, 0, BLOCK)
            part, here = part[here > 0], here[here > 0]
            begin = np.cumsum(here) - here
            row = np.repeat(part, here)
            j = first + np.arange(here.sum()) - np.repeat(begin, here)
            left = np.minimum(m[row] - COINS * j, COINS).astype(np.uint64)
            coins = scrambled(((a[row] + j.astype(np.uint64)) & _WORD) ^ high[row]) & ((np.uint64(1) << left) - np.uint64(1))
            out[part] += np.add.reduceat(np.bitwise_count(coins), begin, dtype=np.int64)
    return out


def order_statistic(s: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Rank (0 to n - 1) of the ``k``-th smallest of ``n`` draws with replacement from ``n`` ranks, for each seed ``s``.

    Draws are uniform points of [0, 1) and a point's rank is floor(point * n).
    Going down the binary tree of intervals, fair coins (bits of hashes of the
    seed and the interval) tell how many of an interval's draws lie in its left
    half, and only the half that holds the wanted draw is followed.  So a
    resample costs about 2 n / 31 hashes, none of it per draw.
    """
    seed = s.astype(np.uint64)
    m, k, u = n.astype(np.int64), k.astype(np.int64), np.zeros(len(n), np.uint64)
    high = (seed >> np.uint64(28)) & _WORD
    for level in range(DIGITS):
        node = np.uint64(1 << level) + u
        heads = _heads(scrambled((seed & _WORD) ^ ((node * np.uint64(0x45D9F3B)) & _WORD)), high, m)
        right = k >= heads
        m, k = np.where(right, m - heads, heads), np.where(right, k - heads, k)
        u = u * np.uint64(2) + right
    u = u.astype(np.int64)
    return ((((u & 65535) * n) >> 16) + (u >> 16) * n) >> 16


@F.pandas_udf(T.StructType([T.StructField("_lo", T.LongType()), T.StructField("_hi", T.LongType())]))
def _middle(s: pd.Series, n: pd.Series) -> pd.DataFrame:
    s, n = s.to_numpy(np.int64), n.to_numpy(np.int64)
    lo = order_statistic(s, n, (n - 1) // 2)
    hi, even = lo.copy(), n % 2 == 0
    hi[even] = order_statistic(s[even], n[even], n[even] // 2)
    return pd.DataFrame({"_lo": lo, "_hi": hi})


def _median_ranks(sizes: DataFrame, by: list[str], seed: int, resamples: int) -> DataFrame:
    """(key, ``_r``, ``_lo``, ``_hi``): ranks of the middle draws of every resample, which need no sample value."""
    rows = (sizes.select(*by, "_n", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("_r"))
            .repartition(*[F.col(k) for k in by], F.col("_r")))
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in by], F.col("_r").cast("string"))
    return rows.withColumn("_s", md5_bigint(text)).withColumn("_m", _middle("_s", "_n")).select(*by, "_r", "_m._lo", "_m._hi")


def _at_ranks(ranked: DataFrame, wanted: DataFrame, by: list[str], value: str) -> DataFrame:
    """``wanted`` (key, ``_r``, ``_lo``, ``_hi``) -> (key, ``_r``, ``_est``): the mean of the values at both ranks."""
    places = wanted.select(*by, "_r", F.explode(F.array("_lo", "_hi")).alias("_i"))
    return join_null_safe(places, ranked.select(*by, "_i", value), [*by, "_i"]).groupBy(*by, "_r").agg(
        ((F.min(value) + F.max(value)) / 2).alias("_est"))


def bootstrap_median(samples: DataFrame, by: Sequence[str], value: str, order: Sequence[str],
                     seed: int = BOOTSTRAP_SEED, resamples: int = BOOTSTRAP_RESAMPLES,
                     confidence: float = 0.95) -> DataFrame:
    """Median and bootstrap confidence interval of the median, per key.

    Values get their rank within the key once (``order`` breaks ties); a
    resample's median is the value at its middle drawn ranks.  One algorithm and one draw definition for every sample size: a
    key's interval depends on its own values only.
    """
    by = list(by)
    base = samples.where(F.col(value).isNotNull()).select(*by, *order, F.col(value).cast("double").alias(value))
    ranked = dense_index(base, by, [value, *order], name="_i").select(*by, "_i", value).checkpoint()
    sizes = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    middle = sizes.select(*by, F.lit(-1).alias("_r"), F.expr("(_n - 1) div 2").alias("_lo"), F.expr("_n div 2").alias("_hi"))
    point = join_null_safe(_at_ranks(ranked, middle, by, value).select(*by, F.col("_est").alias("median")), sizes, by)
    estimates = _at_ranks(ranked, _median_ranks(sizes, by, seed, resamples), by, value)
    # One number per resample: at most ``resamples`` values in a group.
    lo, hi = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    ci = estimates.groupBy(*by).agg(F.percentile(F.col("_est"), F.array(F.lit(lo), F.lit(hi))).alias("_ci"))
    return join_null_safe(point, ci, by, "left").select(
        *by, F.col("_n").alias("n"), "median",
        F.col("_ci")[0].alias("ci95_low"), F.col("_ci")[1].alias("ci95_high"),
        F.lit(seed).alias("seed"), F.lit(resamples).alias("resamples"),
    )


def paired_bootstrap(pairs: DataFrame, by: Sequence[str], a: str, b: str, order: Sequence[str],
                     seed: int = BOOTSTRAP_SEED, resamples: int = BOOTSTRAP_RESAMPLES) -> DataFrame:
    """Median paired % delta ``(b - a) / a * 100`` with a bootstrap CI.

    Keys whose reference side has a zero value get ``zero_base_pairs > 0``
    and NULL statistics (the delta is undefined).
    """
    by = list(by)
    deltas = pairs.withColumn("_delta", percentage_delta(F.col(a), F.col(b)))
    zero = deltas.groupBy(*by).agg(F.count_if(F.col(a) == 0).alias("zero_base_pairs"))
    boot = bootstrap_median(deltas.where(F.col(a) != 0), by, "_delta", order, seed, resamples)
    out = join_null_safe(zero, boot, by, "left")
    bad = F.col("zero_base_pairs") > 0
    return out.select(
        *by,
        F.col("n"),
        F.when(~bad, F.col("median")).alias("median_paired_delta_percent"),
        F.when(~bad, F.col("ci95_low")).alias("ci95_low"),
        F.when(~bad, F.col("ci95_high")).alias("ci95_high"),
        "zero_base_pairs", "seed", "resamples",
    )
