"""Property tests: scalable operators agree with straightforward definitions."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tollgate.operators import stats
from tollgate.operators.sequence import dense_index

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.lists(st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]), min_size=1, max_size=120)


@SETTINGS
@given(keys=keys, seed=st.integers(0, 1000))
def test_dense_index_matches_rank(spark, keys, seed):
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(keys))
    pdf = pd.DataFrame({"k": keys, "o": order.astype("int64")})
    df = spark.createDataFrame(pdf)
    got = dense_index(df, ["k"], ["o"], partitions=4).toPandas().sort_values(["k", "o"])
    want = pdf.assign(_i=pdf.groupby("k")["o"].rank(method="first").astype("int64") - 1).sort_values(["k", "o"])
    assert got["_i"].tolist() == want["_i"].tolist()


@SETTINGS
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_descriptive_matches_linear_percentiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    d = stats.descriptive(df, [], "v").first()
    q = np.percentile(np.array(values), [50, 25, 75, 95])
    assert d.n == len(values)
    for got, want in zip((d.median, d.q1, d.q3, d.p95), q):
        assert abs(got - want) <= 1e-9 * max(1.0, abs(want))


@SETTINGS
@given(data=st.data())
def test_match_applications_matches_brute_force(spark, data):
    import datetime as dt

    from tollgate.operators import evidence

    base = dt.datetime(2024, 1, 1)
    iv = st.tuples(st.integers(0, 600), st.integers(0, 240))
    apps = data.draw(st.lists(st.tuples(st.sampled_from(["x", "x", "y"]), iv), min_size=0, max_size=25))
    tasks = data.draw(st.lists(st.tuples(st.sampled_from(["x", "y"]), iv), min_size=1, max_size=15))
    at = lambda minute: None if minute % 7 == 0 else base + dt.timedelta(minutes=minute)  # noqa: E731  (some bounds are open)
    a_rows = [(f"a{i:02d}", n, at(s), at(s + d)) for i, (n, (s, d)) in enumerate(apps)]
    t_rows = [(f"t{i:02d}", n, at(s), at(s + d)) for i, (n, (s, d)) in enumerate(tasks)]
    a_df = spark.createDataFrame(a_rows, "app_id string, name string, start timestamp, end timestamp")
    t_df = spark.createDataFrame(t_rows, "task_key string, name string, started_at timestamp, finished_at timestamp")
    got = {r.task_key: r.app_id for r in evidence.match_applications(t_df, a_df, partitions=4).collect()}
    want = {}
    for key, name, ts, te in t_rows:
        cands = [(s or dt.datetime.min, aid) for aid, n, s, e in a_rows
                 if n == name and (not e or not ts or e >= ts) and (not s or not te or s <= te)]
        want[key] = max(cands)[1] if cands else None
    assert got == want
