"""hashing helpers (row checksums, canonical-JSON digests)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "\\N"


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit JVM-native row hash (production checksum)."""
    return F.xxhash64(*[F.col(c) for c in columns])


def canonical_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """Engine-portable text of a row.

    Integers and strings as-is, fractional numbers as decimal(38,6),
    timestamps as epoch microseconds, booleans as true/false, NULL as ``\\N``.
    Doubles and timestamps are never rendered as text directly: their text
    forms differ between engines.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in columns:
        t = types[c]
        col = F.col(c)
        if isinstance(t, (T.FloatType, T.DoubleType)):
            col = col.cast("decimal(38,6)").cast("string")
        elif isinstance(t, T.TimestampType):
            col = F.unix_micros(col).cast("string")
        elif isinstance(t, T.TimestampNTZType):
            col = F.unix_micros(F.to_timestamp(col)).cast("string")
        else:
            col = col.cast("string")
        parts.append(F.coalesce(col, F.lit(NULL_TOKEN)))
    return F.concat_ws("|", *parts)


def md5_bigint(text: Column) -> Column:
    """First 60 bits of md5 as a non-negative bigint (reproducible in SQL)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def portable_row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    return md5_bigint(canonical_text(df, columns))


def sha256_json(col: Column) -> Column:
    """SHA-256 of the JSON text of a struct/map column."""
    return F.sha2(F.to_json(col), 256)
