"""Helpers shared by the operators: tables, work tables, Arrow mapping, words."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import checkpoint_root, work_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared work folder and read it back.

    This cuts lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    checkpoint_root(spark)


#: Rows of an Arrow batch: whole texts are long, and each batch is held in the JVM and in Python.
BATCH_ROWS = 1024
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Keeps the session's Arrow batches at BATCH_ROWS rows or fewer."""
    if not 0 < int(spark.conf.get(_ROWS_CONF)) <= BATCH_ROWS:
        spark.conf.set(_ROWS_CONF, str(BATCH_ROWS))


def release_memory() -> None:
    """Gives freed memory back to the system: workers are used again by later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    bounded_batches(df.sparkSession)

    def task(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(task, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def worker_state() -> dict:
    """Values that tasks of one reused Python worker share (task code itself is pickled by value)."""
    return vars(sys.modules.setdefault("_tollgate_worker", types.ModuleType("_tollgate_worker")))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [x or b"" for x in values(column.cast(pa.binary()))]


def values(column: pa.Array) -> list:
    """A column as a list, through numpy (much faster than ``to_pylist`` for many rows)."""
    return column.to_numpy(zero_copy_only=False).tolist()


def doc_hash_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a row's (id, text); repeated rows share it."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_OF_BYTE = np.random.default_rng(7).integers(0, 2 ** 64 - 1, 256, np.uint64)


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self, base: int):
        self.base = base, pow(base, -1, 2 ** 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up, self.down = (np.concatenate([x, x * np.uint64(pow(b, size, 2 ** 64))]) for x, b in zip((self.up, self.down), self.base))
        return self.up[:n], self.down[:n]


#: Fixed odd numbers.
_BYTE_POWERS, _WORD_POWERS = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of bytes other than the six ASCII blanks) of a text, in order.

    A polynomial over random numbers of the bytes, modulo 2**64, for all words from one running sum."""
    data = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero(np.diff(~_BLANK[data], prepend=False, append=False))
    starts, stops = at[::2], at[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _BYTE_POWERS.upto(len(data))
    total = _OF_BYTE[data]
    total *= up
    np.cumsum(total, out=total)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    return mix((total[stops - 1] - before) * down[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` consecutive words (none if fewer), from one running sum."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS.upto(len(words))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up)])
    return mix((total[size:] - total[:-size]) * down[:n])
