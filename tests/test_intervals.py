"""Interval match over many slices, and totals of windows from a two-level time index."""

import datetime as dt
import random
from decimal import Decimal

from tollgate.operators import evidence

BASE = dt.datetime(2024, 1, 1)


def test_match_applications_across_slices(spark):
    rng = random.Random(4)
    at = lambda s: BASE + dt.timedelta(seconds=s)
    # One name holds most rows; long and running applications reach over many slices; some keys are NULL.
    apps = [(f"a{i:04d}", rng.choice(["hot"] * 8 + ["x", None]), rng.choice([None] + [at(rng.randrange(0, 5000, 5))] * 40), None) for i in range(400)]
    apps = [(i, n, s, None if s is None or rng.random() < 0.005 else s + dt.timedelta(seconds=rng.choice([3, 10, 3000 if rng.random() < 0.1 else 4])))
            for i, n, s, _ in apps] + [("b", "y", at(10), at(20))]
    for apps in (apps, [a for a in apps if a[3] is not None]):
        tasks = []
        for i in range(600):
            start = rng.randrange(0, 6000)
            tasks.append((f"t{i}", rng.choice(["hot"] * 8 + ["x", "y", "z", None]), rng.choice([None] + [at(start)] * 20),
                          rng.choice([None] + [at(start + rng.randrange(0, 30))] * 20)))
        tasks += tasks[:5]
        a_df = spark.createDataFrame(apps, "app_id string, name string, start timestamp, end timestamp")
        t_df = spark.createDataFrame(tasks, "task_key string, name string, started_at timestamp, finished_at timestamp")
        got = sorted((r.task_key, r.app_id or "", r.matched) for r in evidence.match_applications(t_df, a_df, partitions=12).collect())
        want = []
        for key, name, ts, te in tasks:
            found = [(s or dt.datetime.min, i) for i, n, s, e in apps
                     if name is not None and n == name and (not e or not ts or e >= ts) and (not s or not te or s <= te)]
            want.append((key, max(found)[1] if found else "", bool(found)))
        assert got == sorted(want)
    assert {r.matched for r in evidence.match_applications(t_df, a_df.limit(0)).collect()} == {False}
    assert evidence.match_applications(t_df.limit(0), a_df).count() == 0


def test_window_totals_against_brute_force(spark):
    rng = random.Random(9)
    points = [(rng.choice("mn"), BASE + dt.timedelta(microseconds=rng.choice([rng.randrange(0, 3_600_000_000), 60_000_000 * rng.randrange(60)])),
               rng.choice([None, Decimal(rng.randrange(1000)) / 8])) for _ in range(500)]
    points += [("m", None, Decimal(5)), ("m", BASE - dt.timedelta(days=20000, seconds=61), Decimal(2))]
    windows = [("w0", BASE, BASE), ("w1", BASE + dt.timedelta(seconds=61), BASE + dt.timedelta(seconds=62)), ("open", BASE, None),
               ("early", BASE - dt.timedelta(days=20001), BASE - dt.timedelta(days=19999)), ("none", BASE + dt.timedelta(days=9), BASE + dt.timedelta(days=9))]
    for i in range(20):
        start = BASE + dt.timedelta(microseconds=rng.choice([rng.randrange(3_000_000_000), 60_000_000 * rng.randrange(50)]))
        windows.append((f"r{i}", start, start + dt.timedelta(seconds=rng.choice([0, 30, 59, 60, 61, 600]), microseconds=rng.choice([0, 999_999]))))
    p = spark.createDataFrame(points, "metric string, ts timestamp, value decimal(20,6)")
    w = spark.createDataFrame(windows, "block string, start timestamp, end timestamp")
    for before, after in ((60, 120), (0, 0)):
        got = {(r.block, r.metric): (r.total, r.datapoints) for r in evidence.totals_in_windows(p, w, before, after).collect()}
        want = {}
        for block, lo, hi in windows:
            for metric, ts, value in points:
                if ts and hi and lo - dt.timedelta(seconds=before) <= ts <= hi + dt.timedelta(seconds=after):
                    total, n = want.get((block, metric), (0, 0))
                    want[block, metric] = total + (value or 0), n + 1
        assert got == want
    totals = evidence.totals_in_windows(p, w)
    done = {r.block: r.complete for r in evidence.window_completeness(w, totals).collect()}
    assert not done["none"] and not done["open"] and done["early"] and done["w0"]
    assert evidence.totals_in_windows(p.limit(0), w).count() == evidence.totals_in_windows(p, w.limit(0)).count() == 0
