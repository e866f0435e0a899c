"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each whole text becomes a vector of document statistics.  Random Fourier
features approximate a Gaussian kernel over the standardized statistics; every
partition sums its part of the normal equations, whose size depends only on
the number of features.  Ridge scores are calibrated by isotonic regression on
labelled rows kept apart from the fit (bounded histogram of scores).

Defined results: null and empty texts get the statistics of an empty text and
a score like any other; labels without a row, without an id or without a value
are ignored, a document labelled more than once counts once per label; without
labels every score is 0.5.  Repeated rows get equal scores; whole texts count,
however long; an empty table gives no rows; other columns are ignored by the
scores and kept by ``keep_good``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import bounded_batches, map_arrow, materialize, release_memory, text_bytes, with_fields

FEATURES = 300
RIDGE = 0.1
#: Frequencies have this deviation, over the root of the number of statistics: the inverse of the kernel's width.
FREQUENCY = 0.5
SEED = 20240517
THRESHOLD = 0.3
#: Cells of the score histogram that calibration is fitted on.
CELLS = 2000
#: Of eight parts of the labelled rows, so many calibrate and the others fit.
CALIBRATION_PARTS, PARTS = 2, 8

_CLASS = np.zeros((256, 9))
for _byte in range(256):
    _c = chr(_byte)
    _kind = (0 if _c.islower() and _byte < 128 else 1 if _c.isupper() and _byte < 128 else 2 if _c.isdigit() and _byte < 128
             else 3 if _c in " \t\r\x0b\f" else 4 if _c == "\n" else 5 if _c in ".,;:" else 6 if _c in "!?" else 7 if _byte < 128 else 8)
    _CLASS[_byte, _kind] = 1
N_STATS = 22


def statistics(raw: bytes) -> np.ndarray:
    """Statistics of one whole text; the empty text has a vector of its own."""
    out = np.zeros(N_STATS)
    if not raw:
        out[0] = 1
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    share = counts @ _CLASS / n
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    w = max(1, len(words))
    p = counts[counts > 0] / n
    distinct = len(set(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    out[1:] = (math.log1p(n), math.log1p(len(words)), math.log1p(len(lines)), *share[:3], *share[5:],
               math.log1p(100 * counts[124] / w), -float(p @ np.log2(p)), sizes.mean(), min(sizes.std(), 20.0),
               distinct / w, repeats / w, (len(lines) - len(set(lines))) / max(1, len(lines)),
               math.log1p(w / max(1, len(lines))), float(share[7] * n / w), float(share[5] * n / w),
               math.log1p(max(sizes.max(), 1)))
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    coef: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.weights + self.phase) * math.sqrt(2 / len(self.phase))
        return np.hstack([f, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coef

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.knots, self.values)


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the statistics vector of each row."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def task(batches):
        for batch in batches:
            stats = [statistics(raw) for raw in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tolist() for s in stats], pa.list_(pa.float64()))],
                                             names=["doc_id", "stats"])

    return map_arrow(slim, task, T.StructType([slim.schema["doc_id"], T.StructField("stats", T.ArrayType(T.DoubleType()))]))


def _summed(rows: DataFrame, fn, size: int) -> np.ndarray:
    """Sum over all partitions of ``fn(stats matrix, labels) -> vector of ``size``.

    One vector per partition, added up by position: ``size`` rows reach the driver."""
    def task(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("stats").to_pylist(), float)
                total += fn(x, batch.column("label").to_numpy(zero_copy_only=False).astype(float))
        blocks = [total[i:i + 4096] for i in range(0, size, 4096)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()),
                                          pa.array([b.tolist() for b in blocks], pa.list_(pa.float64()))], names=["block", "part"])

    def add(groups):
        sums: dict[int, np.ndarray] = {}
        for batch in groups:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = part.values.to_numpy()
                sums[block] = sums[block] + v if block in sums else v.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["block", "part"])

    schema = "block int, part array<double>"
    parts = map_arrow(rows, task, schema).repartition("block")
    out = np.zeros(size)
    for block, part in map_arrow(parts, add, schema).collect():
        out[block * 4096:block * 4096 + len(part)] += part
    return out


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing values."""
    stack: list[list[float]] = []
    for v, w in zip(values, weights):
        stack.append([v, w, 1])
        while len(stack) > 1 and stack[-2][0] >= stack[-1][0]:
            v2, w2, n2 = stack.pop()
            v1, w1, n1 = stack[-1]
            stack[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in stack]) if stack else np.zeros(0)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fit on rows (doc_id, stats, label 0/1)."""
    rng = np.random.default_rng(seed)
    d = N_STATS
    moments = _summed(labelled, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * d)
    n = moments[0]
    mean = moments[2:2 + d] / max(n, 1)
    scale = np.sqrt(np.maximum(moments[2 + d:] / max(n, 1) - mean ** 2, 0))
    scale[scale < 1e-9] = 1
    model = Model(mean, scale, rng.normal(size=(d, features)) / math.sqrt(d) * FREQUENCY, rng.uniform(0, 2 * math.pi, features),
                  None, np.zeros(0), np.zeros(0))
    if n == 0 or moments[1] in (0, n):
        return model
    m = features + 1
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))

    def normal(x, y):
        f = model.features(x)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y])

    sums = _summed(labelled.where(part >= CALIBRATION_PARTS), normal, m * m + m)
    penalty = np.eye(m) * ridge
    penalty[-1, -1] = 1e-6
    coef = np.linalg.solve(sums[:m * m].reshape(m, m) + penalty, sums[m * m:])
    fitted = Model(model.mean, model.scale, model.weights, model.phase, coef, model.knots, model.values)

    def cells(x, y):
        at = np.clip(((fitted.raw(x) + 1) / 3 * CELLS).astype(int), 0, CELLS - 1)
        return np.concatenate([np.bincount(at, minlength=CELLS), np.bincount(at, y, minlength=CELLS)])

    seen = _summed(labelled.where(part < CALIBRATION_PARTS), cells, 2 * CELLS)
    filled = np.flatnonzero(seen[:CELLS])
    if not len(filled):
        fitted.knots, fitted.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return fitted
    weights = seen[filled]
    fitted.values = isotonic(seen[CELLS + filled] / weights, weights)
    fitted.knots = (filled + 0.5) / CELLS * 3 - 1
    return fitted


def labelled_rows(stats: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> DataFrame:
    wanted = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    return stats.select("doc_id", "stats").join(wanted, "doc_id")


def score(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``stats`` rows with score and predicted."""
    schema = with_fields(stats.drop("stats").schema, ("score", T.DoubleType()), ("predicted", T.IntegerType()))
    names = [c for c in stats.columns if c != "stats"]

    def task(batches):
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist(), float).reshape(-1, N_STATS)
            s = model.score(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    return map_arrow(stats, task, schema)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", doc_id: str = "doc_id",
          text: str = "text") -> tuple[Model, DataFrame]:
    """Model fitted on the labelled rows that ``usable`` (over doc_id) admits, and the statistics of all rows."""
    stats = materialize(document_statistics(docs, doc_id, text), "quality-stats")
    rows = materialize(labelled_rows(stats, labels, label, doc_id).where(usable), "quality-labelled")
    return fit(rows), stats


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score under ``threshold``; columns stay.

    Only the texts go through Python and only scores come back: rows neither move nor meet a key."""
    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        x = [statistics(raw) for raw in text_bytes(texts)]
        release_memory()
        return pa.array(model.score(np.array(x)) if x else np.zeros(0))

    bounded_batches(docs.sparkSession)
    return docs.where(scored(F.col(text)) >= threshold)
