"""Quantiles by rank against numpy: hot keys, NULLs, ties, empty groups and tables."""

import random

import numpy as np

from tollgate.operators import stats


def test_quantiles_by_rank(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 9 + ["a", None]), rng.choice([None, 1.0, 2.0, 3.5, rng.random() * 9]), rng.choice([None, rng.randrange(5)])) for _ in range(700)]
    rows += [("one", 2.0, None), ("none", None, None), ("two", 1.0, 4), ("two", 2.0, 4)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    probs = {"v": (0, 0.25, 0.5, 0.95, 1), "w": (0.5, 0.1)}
    got = {r.k: r for r in stats.quantiles(df, ["k"], probs).collect()}
    assert set(got) == {k for k, _, _ in rows}
    for k in got:
        for name, at in (("v", 1), ("w", 2)):
            values = [r[at] for r in rows if r[0] == k and r[at] is not None]
            assert got[k][name].n == len(values)
            if values:
                assert np.allclose(got[k][name].q, np.quantile(np.array(values, float), probs[name]))
            else:
                assert got[k][name].q == [None] * len(probs[name])
    total = stats.quantiles(df, [], {"v": (0.5,)}).collect()
    assert len(total) == 1 and np.isclose(total[0].v.q[0], np.median([v for _, v, _ in rows if v is not None]))
    assert stats.quantiles(df.limit(0), ["k"], probs).count() == 0
    assert [(r.v.n, r.v.q) for r in stats.quantiles(df.limit(0), [], {"v": (0.5,)}).collect()] == [(0, [None])]


def test_no_percentile_aggregate_over_groups(spark, capsys):
    stats.descriptive(spark.createDataFrame([("a", 1.0)], "k string, v double"), ["k"], "v").explain()
    assert "percentile" not in capsys.readouterr().out
