"""Aggregation marts over Silver / audit / metrics tables.

Each mart is one grouped aggregate: Catalyst plans a partial
(map-side) HashAggregate, a shuffle on the group keys only, and a final
HashAggregate, so shuffle volume is bounded by the number of groups per task,
not by the number of rows.  A hot key therefore costs one partial row per
task, never a skewed reduce.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.hashing import portable_row_hash, row_hash
from tollgate.operators.normalize import REVENUE_TRIP
from tollgate.schemas import GOLD_REVENUE

PARTITION_KEYS = ("dataset", "year", "month")


def _keys(df: DataFrame, by: Sequence[str] | None) -> list[str]:
    if by is None:
        return [c for c in PARTITION_KEYS if c in df.columns]
    return list(by)


def with_dataset(df: DataFrame, dataset: str | None) -> DataFrame:
    if dataset is None or "dataset" in df.columns:
        return df
    return df.withColumn("dataset", F.lit(dataset))


# Trip columns summed and averaged over revenue trips.
REVENUE_SUMS = ("fare_amount", "tip_amount", "tolls_amount", "total_amount")
REVENUE_AVERAGES = ("fare_amount", "tip_amount", "trip_distance", "trip_duration_min")


def over_revenue_trips(function: str, column: str) -> Column:
    """An aggregate of the column as double, over revenue trips only."""
    return F.expr(f"{function}(CAST({column} AS DOUBLE)) FILTER (WHERE {REVENUE_TRIP})")


def monthly_revenue(df: DataFrame, dataset: str | None = None,
                    by: Sequence[str] = PARTITION_KEYS,
                    processed_at: Column | None = None) -> DataFrame:
    """A4: gold monthly revenue for every (dataset, year, month) at once.

    Sums over revenue trips default to 0.0, averages stay NULL when a month
    has no revenue trip.
    """
    measures = {"trip_count": F.count("*"), "valid_trip_count": F.count_if("is_valid_trip"),
                "revenue_trip_count": F.count_if(F.expr(REVENUE_TRIP))}
    measures |= {f"{c}_sum": F.ifnull(over_revenue_trips("sum", c), F.lit(0.0)) for c in REVENUE_SUMS}
    measures |= {f"avg_{c}": over_revenue_trips("avg", c) for c in REVENUE_AVERAGES}
    months = with_dataset(df, dataset).groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])
    months = months.withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
    extra = [c for c in by if c not in GOLD_REVENUE.names]
    return months.select(*[F.col(f.name).cast(f.dataType) for f in GOLD_REVENUE.fields], *extra)


def row_count(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """A1: ``count(*)`` per partition (or overall with ``by=[]``)."""
    return df.groupBy(*_keys(df, by)).agg(F.count(F.lit(1)).alias("row_count"))


def financial_aggregate(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """A5 (per partition) / A7 (``by=['dataset']`` or ``[]``: broad scan)."""
    return df.groupBy(*_keys(df, by)).agg(
        F.sum("total_amount").alias("total_amount"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("trip_duration_min").alias("avg_trip_duration_min"),
    )


def pickup_aggregate(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Trips and revenue per pickup location (per partition)."""
    return df.groupBy(*_keys(df, by), "pickup_location_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_amount"),
    )


def status_summary(audit: DataFrame, benchmark_run_id: str | None = None,
                   by: Sequence[str] | None = None) -> DataFrame:
    """Audit rows per status (all rows of a run), ordered by status."""
    if benchmark_run_id is not None:
        audit = audit.where(F.col("benchmark_run_id") == benchmark_run_id)
    keys = _keys(audit, by)
    return (
        audit.groupBy(*keys, "status")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy(*keys, "status")
    )


def latest_status_summary(audit: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Latest row per check (processed_at desc, dag_run_id desc), per status.

    Expressed as ``max_by`` over a struct ordering key instead of a
    ``row_number`` window: a hash aggregate with map-side partials, no sort
    of the whole check history.
    """
    keys = _keys(audit, by)
    latest = audit.groupBy(*keys, "check_name").agg(
        F.max_by("status", F.struct("processed_at", "dag_run_id")).alias("status")
    )
    return (
        latest.groupBy(*keys, "status")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy(*keys, "status")
    )


def trips_by_period(df: DataFrame, by: Sequence[str] = ("year", "month"),
                    dataset_key: bool = True) -> DataFrame:
    """Trips per year or per (year, month), ordered.

    Groups by the stored partition columns (equal to year/month of
    pickup_ts after conformance), so only partition metadata is read.
    """
    keys = (["dataset"] if dataset_key and "dataset" in df.columns else []) + list(by)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count")).orderBy(*keys)


def metrics_by_type(metrics: DataFrame, architecture: str | None = None,
                    environment: str | None = None) -> DataFrame:
    """A10: metric rows per metric_type (optionally for one arch/env)."""
    keys = []
    if architecture is not None:
        metrics = metrics.where(F.col("architecture") == architecture)
    else:
        keys.append("architecture")
    if environment is not None:
        metrics = metrics.where(F.col("environment") == environment)
    else:
        keys.append("environment")
    return (
        metrics.groupBy(*keys, "metric_type")
        .agg(F.count(F.lit(1)).alias("metric_count"))
        .orderBy(*keys, "metric_type")
    )


def content_profile(df: DataFrame, by: Sequence[str] | None = None,
                    portable: bool = False) -> DataFrame:
    """Row count, per-column NULL counts and an order-insensitive checksum.

    The checksum is ``sum(hash(row))`` as decimal(38,0) — unlike XOR it does
    not cancel duplicate rows.  ``portable=True`` uses an md5-prefix hash
    over a canonical text of the row that other engines can reproduce;
    otherwise ``xxhash64`` (JVM-native, much cheaper).
    """
    keys = _keys(df, by)
    value_cols = [c for c in df.columns if c not in keys]
    h = portable_row_hash(df, value_cols) if portable else row_hash(value_cols)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in value_cols],
        F.sum(h.cast("decimal(38,0)")).cast("string").alias("content_checksum"),
    )


def deterministic_results(df: DataFrame, by: Sequence[str] | None = None,
                          exact: bool = True) -> DataFrame:
    """Order-independent fingerprint of a partition.

    Counts, distinct pickups and a decimal(38,6) sum rounded to 4 places and
    rendered as text (decimal sums do not depend on row order).  ``exact``
    False swaps ``count(distinct)`` for ``approx_count_distinct`` (HLL++),
    the variant for very large partitions.
    """
    keys = _keys(df, by)
    distinct = (
        F.count_distinct("pickup_location_id") if exact
        else F.approx_count_distinct("pickup_location_id")
    )
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("is_valid_trip")).alias("valid_trip_count"),
        distinct.alias("pickup_location_count"),
        F.round(F.sum(F.col("total_amount").cast("decimal(38,6)")), 4).cast("string").alias("total_amount_sum"),
    )


def deterministic_pickup(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Per-pickup count and decimal revenue sum, ordered."""
    keys = _keys(df, by)
    return (
        df.groupBy(*keys, "pickup_location_id")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.round(F.sum(F.col("total_amount").cast("decimal(38,6)")), 4).cast("string").alias("total_amount_sum"),
        )
        .orderBy(*keys, "pickup_location_id")
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a deterministic order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
