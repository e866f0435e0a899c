"""Whitening against exact fractions and a dense decomposition."""

import random
from fractions import Fraction

import numpy as np
import pytest

from tollgate.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, deviation string, whitened string, v int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", "clash", 1) for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def vectors():
    rng = random.Random(2)
    mix = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(5)]
    good = [[float(np.float32(sum(a * b for a, b in zip(row, z)))) for row in mix] for z in ([rng.gauss(0, 1) for _ in range(5)] for _ in range(300))]
    good += [good[3]] * 150
    return good, [None, [], [1.0, None, 2.0, 3.0, 4.0], [1.0, float("nan"), 0.0, 0.0, 0.0], [float("inf")] * 5, [1.0, 2.0], [3e38] * 5]


def test_whitening(spark):
    good, bad = vectors()
    got = whitening.whitened_rows(table(spark, bad[:4] + good + bad[4:])).collect()
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in good]
    n, dim = len(x), 5
    s = [sum(r[j] for r in x) for j in range(dim)]
    d = [[n * r[j] - s[j] for j in range(dim)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n ** 3)) for j in range(dim)] for i in range(dim)])
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    assert len(got) == n * dim and {r["n"] for r in got} == {n} and {r["vec_id"] for r in got} == set(range(4, 4 + n))
    want = (np.array(d, float) / n) @ directions / np.sqrt(values)
    model = whitening.fit(table(spark, bad + good))
    assert np.array_equal(model.covariance, v)  # each entry is the exact fraction, rounded once
    for r in got:
        i, k = r["vec_id"] - 4, r["component"] - 1
        assert r["deviation"] == r["deviation_exact"] == sum(c * c for c in d[i])
        assert abs(abs(r["whitened"]) - abs(want[i, k])) < 1e-9
        assert abs(r["explained"] - values[k] / v.trace()) < 1e-9 and r["identity_error"] < 1e-9
    sign = {k: {r["whitened"] * want[r["vec_id"] - 4, k] > 0 for r in got if r["component"] == k + 1 and abs(want[r["vec_id"] - 4, k]) > 1e-6} for k in range(dim)}
    assert all(len(x) == 1 for x in sign.values())


def test_defined_cases(spark):
    assert whitening.whitened_rows(table(spark, [None, []])).count() == 0
    assert whitening.whitened_rows(table(spark, [[1.0]]).limit(0)).count() == 0
    one = whitening.whitened_rows(table(spark, [[1.0, 2.0]])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["identity_error"]) for r in sorted(one, key=lambda r: r["component"])] == [(1, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)]
    line = whitening.whitened_rows(table(spark, [[float(i), 2.0 * i] for i in range(9)])).collect()  # one direction has no variance
    assert {r["whitened"] for r in line if r["component"] == 2} == {0.0} and max(r["identity_error"] for r in line) < 1e-9
    kept = whitening.transform(t := table(spark, [[float(i), 2.0 * i * i] for i in range(9)]), whitening.fit(t))
    assert kept.columns == [*t.columns, "_deviation", "_whitened"] and kept.count() == 9
    assert whitening.transform(t, None).count() == 0
    wide = table(spark, [[float((i * 7 + j * j) % 11) for j in range(40)] for i in range(60)])
    assert {r["component"] for r in whitening.whitened_rows(wide).collect()} == set(range(1, 33))


def test_usual_length(spark):
    assert whitening.usual_length(whitening._vectors(table(spark, [[1.0], [2.0], [1.0, 2.0], [2.0, 3.0], [1.0, 2.0, 3.0]]), "embedding"), 64, 0) == 2


@pytest.mark.parametrize("size", [10, 2 ** 20, 2 ** 40, 2 ** 60, 2 ** 61 - 1])
def test_exact_squares(size):
    rng = random.Random(size)
    x = [[rng.randint(-size, size) for _ in range(3)] for _ in range(50)]
    assert whitening.exact_squares(np.array(x)) == whitening.exact_squares(np.array(x, object)) == [sum(r[j] ** 2 for r in x) for j in range(3)]
    assert whitening.exact_sums(np.array(x)) == [sum(r[j] for r in x) for j in range(3)]


def test_many_rows_stay_exact():
    n = 10 ** 12
    centre = whitening.Centre(n, [n * 1_000_000 + 17, -5])
    x = np.array([[1_000_300, 12], [2 ** 40, -3]])
    assert centre.centred(x).tolist() == [[n * int(a) - s for a, s in zip(r, centre.sums)] for r in x]


def test_large_entries(spark):
    """Deviations beyond 64 bits are null there and exact in the decimal column."""
    df = spark.createDataFrame([(i, [float(i * 10 ** 9), 1.0 * i * i]) for i in range(8)], "vec_id long, embedding array<double>")
    x = [[int(64 * i * 10 ** 9) + 1_000_000, 64 * i * i + 1_000_000] for i in range(8)]
    s = [sum(r[j] for r in x) for j in range(2)]
    want = {i: sum((8 * r[j] - s[j]) ** 2 for j in range(2)) for i, r in enumerate(x)}
    got = whitening.whitened_rows(df).collect()
    assert all(r["deviation_exact"] == want[r["vec_id"]] and r["deviation"] == (want[r["vec_id"]] if want[r["vec_id"]] < 2 ** 63 else None) for r in got)
    assert max(want.values()) >= 2 ** 63
