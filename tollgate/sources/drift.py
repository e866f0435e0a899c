"""Raw files whose schemas drift (S1, S2): one scan per schema, types joined, missing files as rows.

The footers of all files are read in one distributed job, which returns one
short signature per file.  Files of one signature are read by one scan; the
column types of the scans are joined in a promotion lattice and each scan casts
only the columns that differ, so pruning and pushdown reach every scan on the
columns that never drifted.  With one signature this is a plain scan.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widths of whole numbers, and the digits that they need as decimals.
_WHOLE = {"byte": 3, "short": 5, "integer": 10, "long": 20}
#: Footers read by one task, and footer reads at once where only Spark opens the store.
FOOTERS_PER_TASK, THREADS = 64, 16


class DriftError(ValueError):
    """Files disagree on a column in a way that no common type covers."""


def promote(a: T.DataType, b: T.DataType, column: str = "") -> T.DataType:
    """The least type that holds the values of both.

    Whole numbers widen; with fractions they become double; decimals keep all
    digits; a date joins a timestamp; text takes in any other plain type; structs,
    arrays and maps join part by part.  Everything else is a :class:`DriftError`.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = {a.typeName(), b.typeName()}
    if names <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE[t.typeName()])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if names & {"float", "double"}:
            return T.FloatType() if names <= {"float", "byte", "short"} else T.DoubleType()
        digits = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[t.typeName()], 0) for t in (a, b)]
        scale = max(s for _, s in digits)
        return T.DecimalType(min(38, max(w for w, _ in digits) + scale), scale)
    if names <= {"date", "timestamp", "timestamp_ntz"}:
        return T.TimestampType() if "timestamp" in names else T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return T.StructType(list(join_fields([a.fields, b.fields])))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(promote(a.elementType, b.elementType, column))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(promote(a.keyType, b.keyType, column), promote(a.valueType, b.valueType, column))
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)
    if "string" in names and not isinstance(a, nested) and not isinstance(b, nested):
        return T.StringType()
    raise DriftError(f"Column {column!r} is {a.simpleString()} in some files and {b.simpleString()} in others")


def join_fields(schemas: Iterable[Sequence[T.StructField]]) -> Iterator[T.StructField]:
    """The joined fields in order of first appearance; names that differ only in case are one column, named as first seen."""
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for fields in schemas:
        for f in fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            types[key] = promote(types[key], f.dataType, f.name) if key in types else f.dataType
    return (T.StructField(names[k], types[k], True) for k in names)


def _signatures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, signature) of Parquet files; no signature where this process can't open the store, or the file is damaged."""
    import pyarrow.fs
    import pyarrow.parquet

    for frame in frames:
        found = []
        for path in frame["path"]:
            try:
                store, inner = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
                with store.open_input_file(inner) as f:
                    found.append(hashlib.md5(pyarrow.parquet.read_schema(f).remove_metadata().to_string().encode()).hexdigest())
            except Exception:  # noqa: BLE001 - Spark's own reader tells a closed store from a damaged file
                found.append(None)
        yield pd.DataFrame({"path": frame["path"], "signature": found})


def _spark_signature(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """(signature, error) of one file by Spark's reader."""
    try:
        return spark.read.parquet(path).schema.json(), None
    except Exception as e:  # noqa: BLE001 - reported as a row
        return None, str(e).split("\n")[0][:300]


def data_files(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(path, bytes) of the data files under ``paths``, listed without reading them."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            .load(list(paths)).select("path", F.col("length").alias("bytes")))


def file_schemas(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> list[tuple[str, str | None, str | None]]:
    """(path, signature, error) of every data file, by path; three short strings per file reach the driver."""
    listed = data_files(spark, paths, pattern).select("path")
    n = listed.count()
    if not n:
        return []
    read = listed.repartition(-(-n // FOOTERS_PER_TASK)).mapInPandas(_signatures, "path string, signature string").collect()
    rest = [r["path"] for r in read if r["signature"] is None]
    with ThreadPoolExecutor(THREADS) as pool:
        by_spark = dict(zip(rest, pool.map(functools.partial(_spark_signature, spark), rest)))
    return sorted((r["path"], *((r["signature"], None) if r["signature"] else by_spark[r["path"]])) for r in read)


def _conformed(df: DataFrame, wanted: Sequence[T.StructField]) -> DataFrame:
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in wanted:
        mine = have.get(f.name.lower())
        if mine is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            column = F.col(f"`{mine.name}`")
            out.append((column if mine.dataType == f.dataType else column.cast(f.dataType)).alias(f.name))
    return df.select(*out)


def read_drifting(spark: SparkSession, files: Mapping[str, str], extra: Mapping[str, F.Column] | None = None) -> DataFrame:
    """All rows of ``files`` (path -> signature), one scan per signature, in the joined schema.

    ``extra`` adds columns over each scan, such as parts of ``_metadata.file_path``."""
    if not files:
        raise FileNotFoundError("No readable Parquet files")
    groups: dict[str, list[str]] = defaultdict(list)
    for path in sorted(files):
        groups[files[path]].append(path)
    added = dict(extra or {})
    scans = []
    for paths in sorted(groups.values()):
        schema = spark.read.parquet(paths[0]).schema
        scan = spark.read.schema(schema).parquet(*paths)
        scans.append((schema.fields, scan.select("*", *[c.alias(n) for n, c in added.items()])))
    wanted = list(join_fields(fields for fields, _ in scans))
    kept = [f for f in scans[0][1].schema.fields[len(scans[0][0]):]]
    return functools.reduce(DataFrame.unionByName, [_conformed(scan, [*wanted, *kept]) for _, scan in scans])
