"""Run-metric rows from heterogeneous measurements.

Pipeline runs, task instances, query executions and partition-layout
snapshots share the base columns and differ elsewhere; each builder
projects its own columns (with the fixed metric_id composition), and
``union_metrics`` unions them by name (missing columns -> NULL) and types
the result to the 56-column run-metrics schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.scalar import parse_time, seconds_between
from tollgate.schemas import RUN_METRICS

# Base columns every metric row carries.
BASE = ("benchmark_run_id", "comparison_id", "trial_id", "measurement_protocol", "architecture",
        "environment", "file_layout", "workload_name", "dag_id", "dag_run_id", "dataset", "year",
        "month", "repetition")

_TIMESTAMPS = ("started_at", "finished_at", "processed_at")


def _base(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in BASE if c in df.columns]


def _mm(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 2, "0")


def pipeline_rows(dag_runs: DataFrame) -> DataFrame:
    """One row per DAG run: ``{dag_run_id}__pipeline``, duration = end - start."""
    start, end = parse_time(F.col("start_date")), parse_time(F.col("end_date"))
    return dag_runs.select(
        *_base(dag_runs),
        F.concat(F.col("dag_run_id"), F.lit("__pipeline")).alias("metric_id"),
        F.lit("pipeline").alias("metric_type"), F.col("state").alias("status"),
        start.alias("started_at"), end.alias("finished_at"),
        seconds_between(start, end).alias("duration_seconds"),
    )


def task_rows(tasks: DataFrame) -> DataFrame:
    """One row per task instance: ``{dag_run_id}__task__{task_id}``;
    duration falls back to end - start."""
    start, end = parse_time(F.col("start_date")), parse_time(F.col("end_date"))
    return tasks.select(
        *_base(tasks),
        F.concat(F.col("dag_run_id"), F.lit("__task__"), F.col("task_id")).alias("metric_id"),
        F.lit("airflow_task").alias("metric_type"), "task_id", F.col("state").alias("status"),
        "spark_application_id", start.alias("started_at"), end.alias("finished_at"),
        F.coalesce(F.col("duration").cast("double"), seconds_between(start, end)).alias("duration_seconds"),
    )


def query_rows(queries: DataFrame) -> DataFrame:
    """One row per query execution:
    ``{run}__{dataset}_{year}_{MM}__query__{name}__qr{NN}``."""
    mid = F.concat(F.col("benchmark_run_id"), F.lit("__"), F.col("dataset"), F.lit("_"),
                   F.col("year").cast("string"), F.lit("_"), _mm("month"), F.lit("__query__"),
                   F.col("query_name"), F.lit("__qr"), _mm("query_repetition"))
    return queries.select(
        *_base(queries), mid.alias("metric_id"), F.lit("trino_query").alias("metric_type"),
        "query_name", "query_id", F.col("state").alias("status"),
        parse_time(F.col("started_at")).alias("started_at"), parse_time(F.col("finished_at")).alias("finished_at"),
        F.col("duration_seconds").cast("double").alias("duration_seconds"),
        F.col("processed_rows").alias("records_read"), F.col("row_count").alias("result_rows"),
        "physical_input_bytes",
    )


def layout_rows(snapshots: DataFrame) -> DataFrame:
    """One row per table partition snapshot:
    ``{run}__{dataset}_{year}_{MM}__iceberg__{table}__r{NN}``."""
    mid = F.concat(F.col("benchmark_run_id"), F.lit("__"), F.col("dataset"), F.lit("_"),
                   F.col("year").cast("string"), F.lit("_"), _mm("month"), F.lit("__iceberg__"),
                   F.col("table_name"), F.lit("__r"), _mm("repetition"))
    return snapshots.select(
        *_base(snapshots), mid.alias("metric_id"), F.lit("iceberg_partition").alias("metric_type"),
        "table_name", F.col("record_count").alias("records_read"), "file_count",
        F.col("total_size").alias("data_size_bytes"),
    )


def typed_rows(df: DataFrame) -> DataFrame:
    """Project onto the 56 typed columns; ISO-8601 text -> timestamps."""
    present = dict(df.dtypes)
    cols = []
    for f in RUN_METRICS.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in _TIMESTAMPS and present[f.name] == "string":
            cols.append(parse_time(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_metrics(*frames: DataFrame) -> DataFrame:
    """Union heterogeneous metric rows by name and type them."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    if out is None:
        raise ValueError("union_metrics needs at least one frame")
    return typed_rows(out)
