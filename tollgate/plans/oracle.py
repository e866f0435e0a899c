"""Oracle SQL text (DuckDB dialect) for the cross-engine check.

Each registered query has an equivalent SQL statement over the driver's
views.  The adapters and the Silver normalization are shared CTEs so every
statement starts from the same raw tables the Spark plan reads.
"""

from __future__ import annotations

SECS = "((epoch_us(dropoff) // 1000000) - (epoch_us(pickup) // 1000000))"

RAW_TRIPS = """
raw_base AS (
  SELECT CASE WHEN l.l_orderkey % 2 = 0 THEN 'green' ELSE 'yellow' END AS dataset,
         l.l_suppkey % 3 AS vendor,
         o.o_orderdate AS pickup,
         l.l_shipdate AS dropoff,
         CAST(l.l_linenumber AS BIGINT) AS passengers,
         l.l_quantity AS distance,
         CAST(l.l_linenumber % 6 + 1 AS BIGINT) AS ratecode,
         CASE WHEN l.l_returnflag = 'A' THEN 'Y' WHEN l.l_returnflag = 'N' THEN 'N' END AS flag,
         l.l_suppkey AS pu,
         l.l_partkey % 265 + 1 AS dropoff_loc,
         CAST(l.l_linenumber % 4 + 1 AS BIGINT) AS payment,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 2
              THEN -l.l_extendedprice ELSE l.l_extendedprice END AS fare,
         l.l_discount, l.l_tax
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_trips AS (
  SELECT *, fare + tip + tolls AS total
  FROM (SELECT *, fare * l_discount AS tip, fare * l_tax AS tolls FROM raw_base)
)"""

_TIP_RATIO = (
    "CASE WHEN CAST(fare AS FLOAT) > 0 THEN round(CAST(CAST(tip AS FLOAT) AS DOUBLE) / "
    "CAST(CAST(fare AS FLOAT) AS DOUBLE), 2) ELSE 0.0::DOUBLE END"
)

SILVER_YELLOW = f"""
silver_yellow AS (
  SELECT CAST(vendor AS INTEGER) AS vendor_id, pickup AS pickup_ts, dropoff AS dropoff_ts,
         CAST(passengers AS INTEGER) AS passenger_count, CAST(distance AS FLOAT) AS trip_distance,
         CAST(ratecode AS INTEGER) AS rate_code_id, flag AS store_and_fwd_flag,
         CAST(pu AS INTEGER) AS pickup_location_id, CAST(dropoff_loc AS INTEGER) AS dropoff_location_id,
         CAST(payment AS INTEGER) AS payment_type,
         CAST(fare AS FLOAT) AS fare_amount, CAST(NULL AS FLOAT) AS extra, CAST(NULL AS FLOAT) AS mta_tax,
         CAST(tip AS FLOAT) AS tip_amount, CAST(tolls AS FLOAT) AS tolls_amount,
         CAST(NULL AS FLOAT) AS improvement_surcharge, CAST(total AS FLOAT) AS total_amount,
         CAST(NULL AS FLOAT) AS congestion_surcharge, CAST(NULL AS FLOAT) AS airport_fee,
         CAST({SECS} / 60.0::DOUBLE AS FLOAT) AS trip_duration_min,
         CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month,
         CAST({SECS} / 60.0::DOUBLE AS FLOAT) > 0 AS is_valid_trip,
         CAST(tip AS FLOAT) > 0 AS has_tip,
         CAST({_TIP_RATIO} AS FLOAT) AS tip_ratio
  FROM raw_trips WHERE dataset = 'yellow' AND passengers > 0 AND passengers <= 6
)"""

SILVER_GREEN = f"""
silver_green AS (
  SELECT CAST(vendor AS BIGINT) AS vendor_id, pickup AS pickup_ts, dropoff AS dropoff_ts,
         CAST(passengers AS BIGINT) AS passenger_count, CAST(distance AS DOUBLE) AS trip_distance,
         CAST(ratecode AS BIGINT) AS rate_code_id, flag AS store_and_fwd_flag,
         CAST(pu AS BIGINT) AS pickup_location_id, CAST(dropoff_loc AS BIGINT) AS dropoff_location_id,
         CAST(payment AS BIGINT) AS payment_type,
         CAST(fare AS FLOAT) AS fare_amount, CAST(NULL AS FLOAT) AS extra, CAST(NULL AS FLOAT) AS mta_tax,
         CAST(tip AS FLOAT) AS tip_amount, CAST(tolls AS FLOAT) AS tolls_amount,
         CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS FLOAT) AS improvement_surcharge,
         CAST(total AS FLOAT) AS total_amount, CAST(NULL AS DOUBLE) AS congestion_surcharge,
         CAST(NULL AS INTEGER) AS trip_type,
         CAST(trunc({SECS} / 60.0::DOUBLE) AS BIGINT) AS trip_duration_min,
         CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month,
         CAST(trunc({SECS} / 60.0::DOUBLE) AS BIGINT) > 0 AS is_valid_trip,
         CAST(tip AS FLOAT) > 0 AS has_tip,
         {_TIP_RATIO} AS tip_ratio
  FROM raw_trips WHERE dataset = 'green' AND passengers > 0 AND passengers <= 6
)"""

SILVER_ALL = """
silver_all AS (
  SELECT 'yellow' AS dataset, CAST(vendor_id AS BIGINT) AS vendor_id, pickup_ts, dropoff_ts,
         CAST(passenger_count AS BIGINT) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
         store_and_fwd_flag, CAST(pickup_location_id AS BIGINT) AS pickup_location_id,
         CAST(dropoff_location_id AS BIGINT) AS dropoff_location_id,
         fare_amount, tip_amount, tolls_amount, total_amount,
         CAST(trip_duration_min AS DOUBLE) AS trip_duration_min, year, month, is_valid_trip, has_tip,
         CAST(tip_ratio AS DOUBLE) AS tip_ratio
  FROM silver_yellow
  UNION ALL
  SELECT 'green' AS dataset, vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance,
         store_and_fwd_flag, pickup_location_id, dropoff_location_id,
         fare_amount, tip_amount, tolls_amount, total_amount,
         CAST(trip_duration_min AS DOUBLE) AS trip_duration_min, year, month, is_valid_trip, has_tip,
         tip_ratio
  FROM silver_green
)"""


def with_silver(body: str) -> str:
    """Prefix a statement with the raw -> silver CTE chain."""
    return f"WITH {RAW_TRIPS},{SILVER_YELLOW},{SILVER_GREEN},{SILVER_ALL}\n{body}"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _metrics_cte() -> str:
    from tollgate.sources.adapters import (EVENT_METRIC_TYPE, EVENT_QUERY_NAME,
                                           PROTOCOLS, TASK_IDS)
    from tollgate.schemas import RUN_METRICS

    protocols = ", ".join(f"'{p}'" for p in PROTOCOLS)
    tasks = ", ".join(f"'{t}'" for t in TASK_IDS)
    cols = {
        "benchmark_run_id": "run_id",
        "comparison_id": "'cmp-events'",
        "trial_id": "'trial-' || CAST(block AS VARCHAR)",
        "sequence_position": "event_id + 1",
        "measurement_protocol": "protocol",
        "retry_count": "k % 2",
        "metric_id": "run_id || ':' || CAST(event_id AS VARCHAR)",
        "metric_type": "mtype",
        "architecture": "arch",
        "environment": "CASE WHEN arch = 'onprem' THEN 'local' ELSE 'aws' END",
        "file_layout": "CASE WHEN user_id % 2 = 0 THEN 'fragmented' ELSE 'compact' END",
        "workload_name": "'events'",
        "dag_id": "'trip_pipeline'",
        "dag_run_id": "'dag-' || CAST(user_id AS VARCHAR)",
        "task_id": f"CASE WHEN mtype = 'airflow_task' THEN [{tasks}][k % 3 + 1] END",
        "query_name": _case("event_type", EVENT_QUERY_NAME),
        "query_id": "CASE WHEN mtype = 'trino_query' THEN 'q' || CAST(user_id AS VARCHAR) || '-' || CAST(k AS VARCHAR) END",
        "dataset": "ds",
        "year": "CASE WHEN ds = 'green' THEN 2014 ELSE 2011 END",
        "month": "(k % 4) * 3 + 1",
        "repetition": "k % 3 + 1",
        "status": "CASE WHEN value < 1.0 THEN 'FAILED' WHEN mtype = 'trino_query' THEN 'FINISHED' ELSE 'success' END",
        "started_at": "ts",
        "finished_at": "make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT))",
        "duration_seconds": "value",
        "physical_input_bytes": "(k + 1) * 4096",
        "records_read": "k * 1000",
        "file_count": "k % 16 + 1",
        "data_size_bytes": "(k + 1) * 65536",
        "spark_application_id": "CASE WHEN mtype = 'airflow_task' THEN 'app-' || CAST(user_id AS VARCHAR) || '-' || CAST(k % 3 AS VARCHAR) END",
        "table_name": "CASE WHEN mtype = 'iceberg_partition' THEN 'silver.' || ds || '_trips' END",
        "cache_state": "CASE WHEN protocol = 'warm_recorded' THEN 'warm' ELSE 'cold' END",
        "processed_at": "ts",
    }
    duck = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
            "timestamp": "TIMESTAMP"}
    select = ",\n         ".join(
        f"CAST({cols.get(f.name, 'NULL')} AS {duck[f.dataType.simpleString()]}) AS {f.name}"
        for f in RUN_METRICS.fields
    )
    return f"""
ev_stage AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_id % 2 = 0 THEN 'onprem' ELSE 'hybrid_aws' END AS arch,
         {_case('event_type', EVENT_METRIC_TYPE)} AS mtype,
         user_id // 2 AS block
  FROM events
),
ev_blocks AS (
  SELECT *, [{protocols}][block % 3 + 1] AS protocol,
         CASE WHEN block % 2 = 0 THEN 'green' ELSE 'yellow' END AS ds
  FROM ev_stage
),
ev_runs AS (
  SELECT *, 'run-' || CAST(user_id AS VARCHAR) || '-' || arch AS run_id FROM ev_blocks
),
run_metrics AS (
  SELECT {select}
  FROM ev_runs
)"""


METRICS = _metrics_cte()


def with_metrics(body: str, *extra: str) -> str:
    return "WITH " + ",".join((METRICS,) + extra) + "\n" + body
