"""Frames the registered queries start from (derived by Spark from sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.normalize import normalize
from tollgate.session import pin
from tollgate.sources.adapters import raw_trips

# Common columns of both silver tables (widened types) used by cross-dataset marts.
COMMON = [
    ("vendor_id", "bigint"), ("pickup_ts", None), ("dropoff_ts", None),
    ("passenger_count", "bigint"), ("trip_distance", "double"), ("store_and_fwd_flag", None),
    ("pickup_location_id", "bigint"), ("dropoff_location_id", "bigint"),
    ("fare_amount", None), ("tip_amount", None), ("tolls_amount", None), ("total_amount", None),
    ("trip_duration_min", "double"), ("year", None), ("month", None), ("is_valid_trip", None),
    ("has_tip", None), ("tip_ratio", "double"),
]


def silver(spark: SparkSession, sf_dir: str, dataset: str, raw: DataFrame | None = None) -> DataFrame:
    pin(spark)
    return normalize(raw_trips(spark, sf_dir, dataset) if raw is None else raw, dataset)


def common_projection(df: DataFrame, dataset: str) -> DataFrame:
    cols = [F.lit(dataset).alias("dataset")]
    for name, dtype in COMMON:
        c = F.col(name)
        cols.append((c.cast(dtype) if dtype else c).alias(name))
    return df.select(*cols)


def silver_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both silver datasets with a ``dataset`` column (common columns)."""
    return common_projection(silver(spark, sf_dir, "yellow"), "yellow").unionByName(
        common_projection(silver(spark, sf_dir, "green"), "green")
    )
