"""Scalar Column helpers (F1 time, F2 math, F4 strings, F5 size parsing).

All are built-in expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.operators.stats import percentage_delta  # noqa: F401  (F2, re-exported)

# Binary size units of the container sampler.
SIZE_UNITS = {"B": 1, "KiB": 1024, "MiB": 1024**2, "GiB": 1024**3, "TiB": 1024**4}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_size(value, strict: bool = False) -> Column:
    """``"1.5GiB"`` / ``"512 MiB"`` -> bytes (double).

    Unsupported text gives NULL, or a task error with ``strict=True``.
    """
    v = F.trim(_c(value))
    pattern = r"^([0-9.]+)\s*([A-Za-z]+)$"
    number = F.regexp_extract(v, pattern, 1)
    unit = F.regexp_extract(v, pattern, 2)
    units = F.create_map(*[x for k, m in SIZE_UNITS.items() for x in (F.lit(k), F.lit(float(m)))])
    out = F.try_element_at(units, unit) * number.try_cast("double")
    if strict:
        return F.when(out.isNotNull(), out).otherwise(
            F.raise_error(F.concat(F.lit("Unsupported size: "), F.coalesce(v, F.lit("NULL")))))
    return out


def parse_time(value) -> Column:
    """ISO-8601 (``Z`` or offset) or ``...GMT`` history timestamps; else NULL."""
    v = F.regexp_replace(_c(value).cast("string"), "GMT$", "Z")
    return F.try_to_timestamp(v)


def seconds_between(start, end) -> Column:
    """F1: seconds from ``start`` to ``end`` (microsecond precision)."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / 1_000_000


def next_partition(year, month) -> Column:
    """The following (year, month) with year rollover, as a struct."""
    nxt = F.add_months(F.make_date(_c(year), _c(month), F.lit(1)), 1)
    return F.struct(F.year(nxt).alias("year"), F.month(nxt).alias("month"))


def partition_label(year, month) -> Column:
    """``YYYY-MM`` label."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def parse_partition_label(label) -> Column:
    """``YYYY-MM`` -> struct(year, month)."""
    parts = F.split(_c(label), "-")
    return F.struct(parts[0].cast("int").alias("year"), parts[1].cast("int").alias("month"))


def month_file_path(base: str, dataset, year, month) -> Column:
    """``{base}/{year}/{dataset}_tripdata_{year}-{MM}.parquet``."""
    y = _c(year).cast("string")
    return F.concat(F.lit(base.rstrip("/") + "/"), y, F.lit("/"), _c(dataset), F.lit("_tripdata_"),
                    partition_label(year, month), F.lit(".parquet"))
