"""Embedding whitening with covariances by polarisation.

A vector entry c becomes the integer x = floor(scale * c) + offset.  With n
vectors and per-dimension sums S, the centred integers d = n * x - S are squared
and summed exactly for every dimension and for the sum of every pair of
dimensions.  Half the difference between a pair's sum and the sums of its two
dimensions is their exact co-moment; divided by n**3 it is the covariance.  The
matrix, whose size depends on the dimension only, goes to ``eigh``.

Integers stay exact at any size: squares are summed in 64 bits where they fit,
else in 21-bit limbs, else as Python integers; totals travel as two decimals.

Defined results: rows whose vector is null or empty, or holds null, non-finite
or (scaled) entries of 2**61 or more, are left out; so are vectors whose length
is not the most frequent one (the longer on a tie).  Repeated rows count each.
An empty table gives no rows.  Directions without variance (eigenvalue at most
dimension * epsilon times the largest) have the whitened value 0 and don't count
in ``identity_error``.  Other columns are kept; the added names get a leading
``_`` if they are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import fresh, map_arrow, with_fields

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Entries beyond this (scaled) are treated as non-finite.
LARGEST = 2 ** 61
#: Numbers of one block of rows inside a task, and rows of one batch of totals.
BLOCK, BATCH = 2 ** 19, 50_000
#: Totals travel as high * WHOLE + low.
WHOLE = 10 ** 18
LIMB = 21

_TOTALS = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                        T.StructField("high", T.DecimalType(38, 0)), T.StructField("low", T.LongType())])


def integer_vectors(column: pa.Array, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of each usable row's vector (0: unusable), its start, and all entries as integers."""
    starts = column.offsets.to_numpy()
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(column.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        fine = np.abs(scaled) < LARGEST
    bad = np.concatenate([[0], np.cumsum(~fine)])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[starts[1:]] == bad[starts[:-1]])
    return np.where(usable, np.diff(starts), 0), starts[:-1], np.where(fine, scaled, 0).astype(np.int64) + offset


def matrices(column: pa.Array, dim: int, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integers) of the rows with ``dim`` entries, in blocks."""
    lengths, starts, entries = integer_vectors(column, scale, offset)
    rows, step = np.flatnonzero(lengths == dim), max(1, BLOCK // dim)
    for at in range(0, len(rows), step):
        block = rows[at:at + step]
        yield block, entries[starts[block][:, None] + np.arange(dim)]


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if x.dtype == object or int(np.abs(x).max(initial=0)) * len(x) >= 2 ** 62:
        x = x.astype(object)
    return [int(v) for v in x.sum(axis=0)]


def exact_squares(x: np.ndarray) -> list[int]:
    """Column sums of squares as Python integers, exact whatever their size."""
    if x.dtype == object:
        return [int(v) for v in (x * x).sum(axis=0)]
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 2 ** 63:
        return [int(v) for v in np.einsum("ij,ij->j", x, x)]
    mask = (1 << LIMB) - 1
    limbs = [x & mask, (x >> LIMB) & mask, x >> 2 * LIMB]
    total = [0] * x.shape[1]
    for a in range(3):
        for b in range(a, 3):
            part = np.einsum("ij,ij->j", limbs[a], limbs[b])
            total = [t + ((1 + (a != b)) * int(p) << LIMB * (a + b)) for t, p in zip(total, part)]
    return total


@dataclass
class Centre:
    """Number of vectors and their sums; ``centred`` gives n * x - S exactly."""

    n: int
    sums: list[int]
    low: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)

    def __post_init__(self):
        self.low = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        y = x - self.low
        if (int(np.abs(y).max(initial=0)) + 1) * self.n >= LARGEST:
            return y.astype(object) * self.n - self.rest.astype(object)
        return y * self.n - self.rest

    def mean_free(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in doubles, without the cancellation of two large numbers."""
        return (x - self.low) - self.rest / self.n


@dataclass
class Model:
    dim: int
    centre: Centre
    #: Covariance of the integers, its eigenvalues (falling) and unit eigenvectors (columns).
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int
    offset: int
    identity_error: float = 0.0

    @property
    def n(self) -> int:
        return self.centre.n

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) if self.trace else 0.0 for v in self.values]

    def with_variance(self) -> np.ndarray:
        return self.values > self.dim * np.finfo(float).eps * self.values.max(initial=0)

    def weights(self) -> np.ndarray:
        """Maps mean-free rows to whitened ones."""
        live = self.with_variance()
        return np.where(live, self.vectors / np.sqrt(np.where(live, self.values, 1.0)), 0.0)


def _batches(cells: Iterator[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        i, j, total = zip(*held)
        high, low = zip(*(divmod(t, WHOLE) for t in total))
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                           pa.array([Decimal(h) for h in high], pa.decimal128(38, 0)), pa.array(low, pa.int64())], _TOTALS.names)

    for cell in cells:
        held.append(cell)
        if len(held) == BATCH:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _collected(cells: DataFrame) -> dict[tuple[int, int], int]:
    """Totals by (i, j); their number depends on the dimension only."""
    wide = T.DecimalType(38, 0)
    rows = cells.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect()
    return {(r["i"], r["j"]): int(r["high"]) * WHOLE + int(r["low"]) for r in rows}


def usual_length(vectors: DataFrame, scale: int, offset: int) -> int:
    """The most frequent length of usable vectors (0 without any)."""
    def lengths(batches):
        counts: dict[int, int] = {}
        for b in batches:
            for k, c in zip(*np.unique(integer_vectors(b.column(0), scale, offset)[0], return_counts=True)):
                counts[int(k)] = counts.get(int(k), 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], ["len", "n"])

    found = (map_arrow(vectors, lengths, "len long, n long").where("len > 0").groupBy("len").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), F.desc("len")).limit(1).collect())
    return found[0]["len"] if found else 0


def _count_and_sums(vectors: DataFrame, dim: int, scale: int, offset: int) -> Centre | None:
    def sums(batches):
        n, total = 0, [0] * dim
        for b in batches:
            for _, x in matrices(b.column(0), dim, scale, offset):
                n, total = n + len(x), [t + s for t, s in zip(total, exact_sums(x))]
        yield from _batches(iter([(-1, -1, n), *((j, j, t) for j, t in enumerate(total))]))

    found = _collected(map_arrow(vectors, sums, _TOTALS))
    n = found.get((-1, -1), 0)
    return Centre(n, [found[j, j] for j in range(dim)]) if n else None


def squared_sums(vectors: DataFrame, dim: int, centre: Centre, scale: int, offset: int) -> dict[tuple[int, int], int]:
    """Exact sums over all rows of d_i**2 at (i, i) and of (d_i + d_j)**2 at (i, j), i < j."""
    def squares(batches):
        total = [[0] * (dim - i) for i in range(dim)]
        for b in batches:
            for _, x in matrices(b.column(0), dim, scale, offset):
                d = centre.centred(x)
                for i in range(dim):
                    part = exact_squares(np.concatenate([d[:, i:i + 1], d[:, i:i + 1] + d[:, i + 1:]], axis=1))
                    total[i] = [t + p for t, p in zip(total[i], part)]
        yield from _batches((i, i + k, t) for i in range(dim) for k, t in enumerate(total[i]))

    return _collected(map_arrow(vectors, squares, _TOTALS))


def covariance(squared: dict[tuple[int, int], int], dim: int, n: int) -> np.ndarray:
    """Polarisation: 2 * sum d_i d_j = sum (d_i + d_j)**2 - sum d_i**2 - sum d_j**2, each entry rounded once."""
    out = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            product = squared[i, i] if i == j else (squared[i, j] - squared[i, i] - squared[j, j]) // 2
            out[i, j] = out[j, i] = product / n ** 3
    return out


def _identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    dim, centre, weights, scale, offset = model.dim, model.centre, model.weights(), model.scale, model.offset
    k = weights.shape[1]

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            for _, x in matrices(b.column(0), dim, scale, offset):
                w = centre.mean_free(x) @ weights
                first += w.sum(axis=0)
                second += w.T @ w
        i, j = np.indices((k + 1, k))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(np.vstack([second, first]).ravel())], ["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for r in map_arrow(vectors, moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"] / model.n
    live = np.flatnonzero(model.with_variance())
    gap = total[:k] - np.outer(total[k], total[k]) - np.eye(k)
    return float(np.abs(gap[np.ix_(live, live)]).max(initial=0.0))


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.col(vector).cast("array<double>").alias("v"))


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Model | None:
    """The whitening of all usable vectors; None without any."""
    vectors = _vectors(df, vector)
    dim = usual_length(vectors, scale, offset)
    centre = _count_and_sums(vectors, dim, scale, offset) if dim else None
    if centre is None:
        return None
    v = covariance(squared_sums(vectors, dim, centre, scale, offset), dim, centre.n)
    values, directions = np.linalg.eigh(v)
    keep = np.argsort(-values, kind="stable")[:components]
    values, directions = np.maximum(values[keep], 0.0), directions[:, keep]
    directions = directions * np.where(directions[np.abs(directions).argmax(axis=0), np.arange(len(keep))] < 0, -1.0, 1.0)
    model = Model(dim, centre, v, values, directions, float(np.trace(v)), scale, offset)
    model.identity_error = _identity_error(vectors, model)
    return model


def transform(df: DataFrame, model: Model | None, vector: str = "embedding") -> DataFrame:
    """The usable rows with two more columns: ``deviation`` (exact sum over dimensions of
    (n * x - S)**2, decimal) and ``whitened`` (one double per component)."""
    deviation, whitened, held = fresh(df, "deviation"), fresh(df, "whitened"), fresh(df, "vector")
    schema = with_fields(df.schema, (deviation, T.DecimalType(38, 0)), (whitened, T.ArrayType(T.DoubleType())))
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, centre, weights, scale, offset = model.dim, model.centre, model.weights(), model.scale, model.offset

    def rows(batches):
        for b in batches:
            for block, x in matrices(b.column(b.num_columns - 1), dim, scale, offset):
                w = centre.mean_free(x) @ weights
                off = pa.array([Decimal(t) for t in exact_squares(centre.centred(x).T)], pa.decimal128(38, 0))
                spread = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel()))
                kept = b.take(pa.array(block))
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], off, spread], schema.names)

    return map_arrow(df.withColumn(held, F.col(vector).cast("array<double>")), rows, schema)


def whitened_rows(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component; ``deviation`` is null where 64 bits can't hold it (``deviation_exact`` can)."""
    model = fit(df, vector)
    out = transform(df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")), model, "v")
    explained = F.array(*[F.lit(x) for x in model.explained]) if model else F.array().cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "whitened", explained[F.col("at")].alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"), F.col("deviation").alias("deviation_exact"))
