"""Fixed table schemas (column names, order and types are fixed values).

Column lists below must equal the published table definitions so that a
user's existing tables and queries keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name type, ..."`` -> StructType (usable before a session exists)."""
    fields = []
    for item in spec.split(","):
        name, dtype = item.split()
        fields.append(T.StructField(name, _TYPES[dtype], True))
    return T.StructType(fields)


# Silver yellow trips, 25 columns in table order.
SILVER_YELLOW = _struct(
    "vendor_id int, pickup_ts timestamp, dropoff_ts timestamp, passenger_count int, "
    "trip_distance float, rate_code_id int, store_and_fwd_flag string, "
    "pickup_location_id int, dropoff_location_id int, payment_type int, "
    "fare_amount float, extra float, mta_tax float, tip_amount float, "
    "tolls_amount float, improvement_surcharge float, total_amount float, "
    "congestion_surcharge float, airport_fee float, trip_duration_min float, "
    "year int, month int, is_valid_trip boolean, has_tip boolean, tip_ratio float"
)

# Silver green trips, 26 columns in table order.
SILVER_GREEN = _struct(
    "vendor_id bigint, pickup_ts timestamp, dropoff_ts timestamp, passenger_count bigint, "
    "trip_distance double, rate_code_id bigint, store_and_fwd_flag string, "
    "pickup_location_id bigint, dropoff_location_id bigint, payment_type bigint, "
    "fare_amount float, extra float, mta_tax float, tip_amount float, "
    "tolls_amount float, ehail_fee double, improvement_surcharge float, "
    "total_amount float, congestion_surcharge double, trip_type int, "
    "trip_duration_min bigint, year int, month int, is_valid_trip boolean, "
    "has_tip boolean, tip_ratio double"
)

SILVER = {"yellow": SILVER_YELLOW, "green": SILVER_GREEN}
SILVER_PARTITION_COLUMNS = ["year", "month"]

# Quality audit rows, 13 columns.
QUALITY_RESULTS = _struct(
    "benchmark_run_id string, dag_run_id string, repetition int, dataset string, "
    "year int, month int, check_name string, severity string, status string, "
    "observed_value string, threshold string, extra string, processed_at timestamp"
)
QUALITY_PARTITION_COLUMNS = ["dataset", "year", "month"]

# Gold monthly revenue, 15 columns.
GOLD_REVENUE = _struct(
    "dataset string, year int, month int, trip_count bigint, valid_trip_count bigint, "
    "revenue_trip_count bigint, fare_amount_sum double, tip_amount_sum double, "
    "tolls_amount_sum double, total_amount_sum double, avg_fare_amount double, "
    "avg_tip_amount double, avg_trip_distance double, avg_trip_duration_min double, "
    "processed_at timestamp"
)
GOLD_PARTITION_COLUMNS = ["dataset", "year", "month"]

# Benchmark run metrics, 56 columns.
RUN_METRICS = _struct(
    "benchmark_run_id string, comparison_id string, trial_id string, "
    "sequence_position int, measurement_protocol string, retry_count int, "
    "metric_id string, metric_type string, architecture string, environment string, "
    "file_layout string, workload_name string, dag_id string, dag_run_id string, "
    "task_id string, query_name string, query_id string, dataset string, year int, "
    "month int, repetition int, status string, started_at timestamp, "
    "finished_at timestamp, duration_seconds double, queued_time_ms bigint, "
    "planning_time_ms bigint, cpu_time_ms bigint, physical_input_bytes bigint, "
    "peak_memory_bytes bigint, records_read bigint, records_written bigint, "
    "result_rows bigint, input_bytes bigint, output_bytes bigint, "
    "executor_run_time_ms bigint, memory_bytes_spilled bigint, "
    "disk_bytes_spilled bigint, shuffle_read_bytes bigint, shuffle_read_records bigint, "
    "shuffle_write_bytes bigint, shuffle_write_records bigint, "
    "spark_application_id string, table_name string, file_count bigint, "
    "data_size_bytes bigint, metric_name string, metric_value double, "
    "metric_unit string, cache_state string, error_class string, "
    "error_message string, git_sha string, config_hash string, artifact_path string, "
    "processed_at timestamp"
)
RUN_METRICS_PARTITION_COLUMNS = ["architecture", "environment", "workload_name", "metric_type"]

# metric_type vocabulary.
METRIC_TYPES = ("pipeline", "airflow_task", "trino_query", "iceberg_partition")
