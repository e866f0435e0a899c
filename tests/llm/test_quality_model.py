"""The distributed fit against the same steps in one process."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tollgate.llm import rff_quality as q
from tollgate.llm.common import doc_hash_remainder


def test_fit_like_a_plain_one(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta,", "gamma.", "x9"]) + ("%%%" if rng.random() < 0.2 + 0.4 * (i % 2) else "") for _ in range(rng.randint(3, 60))) for i in range(300)]
    texts += [None, "", texts[0], texts[0], "word " * 60_000, "x" * 200_000]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, stats string, score int").repartition(5)
    labels = spark.createDataFrame([(i, 1 - i % 2, "c") for i in range(306)], "doc_id long, quality int, stats string")
    model, stats = q.train(df, labels, doc_hash_remainder(F.col("doc_id"), 5) != 0)
    got = {r["doc_id"]: r["score"] for r in q.score(stats, model).collect()}
    part = {r["doc_id"]: r["p"] for r in stats.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(q.PARTS)).alias("p")).collect()}
    import zlib

    x = np.array([q.statistics((t or "").encode()) for t in texts])
    used = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i in range(306)])
    fit = used & np.array([part[i] >= q.CALIBRATION_PARTS for i in range(306)])
    y = np.array([1.0 - i % 2 for i in range(306)])
    scale = x[used].std(0)
    scale[scale < 1e-9] = 1
    draw = np.random.default_rng(q.SEED)
    w, phase = draw.normal(size=(q.N_STATS, q.FEATURES)) / math.sqrt(q.N_STATS) * q.FREQUENCY, draw.uniform(0, 2 * math.pi, q.FEATURES)
    f = np.hstack([np.cos(np.clip((x - x[used].mean(0)) / scale, -8, 8) @ w + phase) * math.sqrt(2 / q.FEATURES), np.ones((306, 1))])
    penalty = np.diag([q.RIDGE] * q.FEATURES + [1e-6])
    raw = f @ np.linalg.solve(f[fit].T @ f[fit] + penalty, f[fit].T @ y[fit])
    cell = np.clip(((raw + 1) / 3 * q.CELLS).astype(int), 0, q.CELLS - 1)
    rest = used & ~fit
    cells = sorted(set(cell[rest]))
    means, sizes = [y[rest & (cell == c)].mean() for c in cells], [(rest & (cell == c)).sum() for c in cells]
    # Isotonic by definition: the largest over left ends of the smallest over right ends of the weighted means.
    steps = [max(min(np.average(means[a:b], weights=sizes[a:b]) for b in range(i + 1, len(cells) + 1)) for a in range(i + 1)) for i in range(len(cells))]
    want = np.interp(raw, (np.array(cells) + 0.5) / q.CELLS * 3 - 1, steps)
    assert max(abs(got[i] - want[i]) for i in range(306)) < 1e-6 and got[302] == got[0] == got[303]
    kept = q.keep_good(df, model)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(306) if got[i] >= q.THRESHOLD}
    assert q.keep_good(df.limit(0), model).count() == 0
