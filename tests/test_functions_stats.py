import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollgate.functions.scalar import next_partition, parse_size, parse_time, partition_label
from tollgate.operators import stats
from tollgate.operators.sequence import dense_index, first_per_group, with_sequence


def test_parse_size(spark):
    df = spark.createDataFrame([("1.5GiB",), ("512 MiB",), ("10B",), ("3 KB",), (None,)], "s string")
    got = [r.b for r in df.select(parse_size("s").alias("b")).collect()]
    assert got == [1.5 * 1024**3, 512 * 1024**2, 10.0, None, None]


def test_parse_size_strict_raises(spark):
    df = spark.createDataFrame([("3 KB",)], "s string")
    with pytest.raises(Exception):
        df.select(parse_size("s", strict=True)).collect()


def test_parse_time_formats(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05.250GMT",), ("nonsense",)], "s string")
    got = [r.t for r in df.select(parse_time("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] == dt.datetime(2024, 1, 2, 3, 4, 5, 250000)
    assert got[2] is None


def test_next_partition_rollover(spark):
    df = spark.createDataFrame([(2014, 12), (2014, 1)], "y int, m int")
    got = [(r.n.year, r.n.month, r.l) for r in df.select(next_partition("y", "m").alias("n"),
                                                          partition_label("y", "m").alias("l")).collect()]
    assert got == [(2015, 1, "2014-12"), (2014, 2, "2014-01")]


def test_dense_index_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", i) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = dense_index(df, ["k"], ["v"], partitions=8)
    for key, n in (("hot", 500), ("cold", 7)):
        got = sorted((r.v, r._i) for r in out.where(F.col("k") == key).collect())
        assert got == [(i, i) for i in range(n)]


def test_with_sequence_contiguous(spark):
    df = spark.range(100).withColumn("o", (F.col("id") * 7) % 100)
    seq = [r.sequence_position for r in with_sequence(df, ["o"]).orderBy("o").collect()]
    assert seq == list(range(1, 101))


def test_first_per_group(spark):
    df = spark.createDataFrame([("y", 2011, 4), ("y", 2011, 1), ("g", 2014, 1)], "dataset string, year int, month int")
    got = {r.dataset: (r.year, r.month) for r in first_per_group(df, ["dataset"], ["year", "month"]).collect()}
    assert got == {"y": (2011, 1), "g": (2014, 1)}


def samples(spark):
    rows = [("k1", f"p{i:02d}", float(v)) for i, v in enumerate([3, 1, 4, 1, 5, 9, 2, 6])]
    rows += [("k2", f"p{i:02d}", float(v)) for i, v in enumerate([10, 20, 30])]
    return spark.createDataFrame(rows, "key string, pair string, v double")


def test_bootstrap_deterministic_and_bounded(spark):
    df = samples(spark)
    a = {r.key: r for r in stats.bootstrap_median(df, ["key"], "v", ["pair"], seed=7, resamples=300).collect()}
    b = {r.key: r for r in stats.bootstrap_median(df, ["key"], "v", ["pair"], seed=7, resamples=300).collect()}
    assert a == b
    assert a["k1"].median == 3.5 and a["k1"].n == 8
    assert 1.0 <= a["k1"].ci95_low <= a["k1"].median <= a["k1"].ci95_high <= 9.0


def plain_rank(s, n, k):
    """The documented descent, coin by coin."""
    def scrambled(x):
        for _ in range(2):
            x = (x ^ x >> 16) * 0x45D9F3B & 0xFFFFFFFF
        return x ^ x >> 16

    m, u = n, 0
    for level in range(32):
        a = scrambled(s & 0xFFFFFFFF ^ (2 ** level + u) * 0x45D9F3B & 0xFFFFFFFF)
        coins = [scrambled((a + i // 31 & 0xFFFFFFFF) ^ s >> 28 & 0xFFFFFFFF) >> i % 31 & 1 for i in range(m)]
        left = sum(coins)
        u *= 2
        if k < left:
            m = left
        else:
            m, k, u = m - left, k - left, u + 1
    return u * n >> 32


def plain_intervals(values, key, seed, resamples):
    import hashlib

    import numpy as np

    values, n, estimates = sorted(values), len(values), []
    for r in range(resamples):
        s = int(hashlib.md5(f"{seed}:{key}:{r}".encode()).hexdigest()[:15], 16)
        estimates.append((values[plain_rank(s, n, (n - 1) // 2)] + values[plain_rank(s, n, n // 2)]) / 2)
    return np.quantile(estimates, [0.025, 0.975]).tolist()


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1001])
def test_order_statistics_are_those_of_draws(n):
    """The middle ranks have the distribution of the middle of n draws with replacement."""
    import numpy as np

    rng = np.random.default_rng(n)
    runs = 20_000
    s = rng.integers(0, 2 ** 60, runs)
    size = np.full(runs, n)
    for k in {0, (n - 1) // 2, n // 2, n - 1}:
        got = stats.order_statistic(s, size, np.full(runs, k))
        want = np.partition(rng.integers(0, n, (runs, n), dtype=np.int32), k, axis=1)[:, k]
        assert 0 <= got.min() and got.max() < n
        grid = np.arange(n)
        gap = np.abs(np.searchsorted(np.sort(got), grid, "right") - np.searchsorted(np.sort(want), grid, "right")).max() / runs
        assert gap < 1.95 * np.sqrt(2 / runs)  # two samples, Kolmogorov-Smirnov at 0.1 %
    lo, hi = stats.order_statistic(s, size, (size - 1) // 2), stats.order_statistic(s, size, size // 2)
    assert (lo <= hi).all()


def test_order_statistic_of_many_draws():
    import numpy as np

    n = 10_000_000
    got = stats.order_statistic(np.array([5, 6, 7]), np.full(3, n), np.full(3, n // 2))
    assert (np.abs(got - n // 2) < 6 * np.sqrt(n) / 2).all() and len(set(got.tolist())) == 3


def test_bootstrap_against_plain_version(spark):
    import random

    rng = random.Random(5)
    rows = [(k, f"p{i:05d}", float(rng.randrange(1000))) for k, n in (("a", 1), ("b", 2), ("c", 333), ("d", 5000)) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, pair string, v double")
    got = {r.key: r for r in stats.bootstrap_median(df, ["key"], "v", ["pair"], seed=3, resamples=40).collect()}
    for k in "abcd":
        lo, hi = plain_intervals([v for key, _, v in rows if key == k], k, 3, 40)
        assert abs(got[k].ci95_low - lo) < 1e-9 and abs(got[k].ci95_high - hi) < 1e-9


def test_bootstrap_of_a_key_ignores_other_keys(spark):
    def intervals(frame):
        return {r.key: r for r in stats.bootstrap_median(frame, ["key"], "v", ["pair"], seed=3, resamples=50).collect()}

    df = samples(spark)
    alone = intervals(df)
    large = spark.range(25_000).selectExpr("'big' AS key", "CAST(id AS STRING) AS pair", "CAST(id * 7 % 1009 AS DOUBLE) AS v")
    both = intervals(df.unionByName(large))
    assert both.pop("big").n == 25_000
    assert both == alone


def test_paired_bootstrap_zero_base(spark):
    df = spark.createDataFrame([("k", "p1", 0.0, 1.0), ("k", "p2", 2.0, 3.0)], "key string, pair string, a double, b double")
    r = stats.paired_bootstrap(df, ["key"], "a", "b", ["pair"], resamples=50).first()
    assert r.zero_base_pairs == 1 and r.median_paired_delta_percent is None


def test_scale_variants_close_to_exact(spark):
    from tollgate.operators import marts

    df = spark.range(1000).select((F.col("id") % 2).alias("k"), (F.col("id") * 1.0).alias("v"))
    exact = {r.k: r for r in stats.descriptive(df, ["k"], "v").collect()}
    approx = {r.k: r for r in stats.descriptive(df, ["k"], "v", approx=True).collect()}
    for k in (0, 1):
        assert abs(exact[k].median - approx[k].median) <= 2.0
    trips = spark.range(500).select(F.lit(2014).alias("year"), F.lit(1).alias("month"),
                                    (F.col("id") % 37).alias("pickup_location_id"),
                                    (F.col("id") % 3 == 0).alias("is_valid_trip"),
                                    F.lit(1.5).cast("float").alias("total_amount"))
    e = marts.deterministic_results(trips).first()
    a = marts.deterministic_results(trips, exact=False).first()
    assert e.pickup_location_count == 37 and abs(a.pickup_location_count - 37) <= 2
    assert e.total_amount_sum == "750.0000" and e.valid_trip_count == 167


def test_coins_in_blocks(monkeypatch):
    import numpy as np

    s, n = np.arange(40) * 10 ** 15, np.array([1, 31, 32, 500, 5000] * 8)
    want = stats.order_statistic(s, n, n // 2)
    assert want.tolist() == [plain_rank(int(a), int(b), int(b) // 2) for a, b in zip(s, n)]
    for block in (1, 7, 40):
        monkeypatch.setattr(stats, "BLOCK", block)
        assert (stats.order_statistic(s, n, n // 2) == want).all()
