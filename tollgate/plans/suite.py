"""The benchmark query suite as parameterized SQL templates.

Table names bind through ``IDENTIFIER(:...)`` and values through named
parameter markers — nothing is spliced into SQL text.  Tables are passed as
DataFrames (registered as temp views) or as catalog names.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tollgate.sources.files import run_template

# Query names of the suite (plain, correctness, performance).
SUITE = {
    "01_partition_row_count": """
        SELECT count(*) AS row_count FROM IDENTIFIER(:silver)
        WHERE year = :year AND month = :month""",
    "02_quality_result_summary": """
        SELECT status, count(*) AS check_count FROM IDENTIFIER(:quality)
        WHERE benchmark_run_id = :run_id AND dataset = :dataset AND year = :year AND month = :month
        GROUP BY status ORDER BY status""",
    "03_gold_revenue_check": """
        SELECT trip_count, valid_trip_count, revenue_trip_count, total_amount_sum,
               avg_trip_distance, avg_trip_duration_min
        FROM IDENTIFIER(:gold) WHERE dataset = :dataset AND year = :year AND month = :month""",
    "04_partition_financial_aggregation": """
        SELECT sum(total_amount) AS total_amount, avg(trip_distance) AS avg_trip_distance,
               avg(trip_duration_min) AS avg_trip_duration_min
        FROM IDENTIFIER(:silver) WHERE year = :year AND month = :month""",
    "05_pickup_location_aggregation": """
        SELECT pickup_location_id, count(*) AS trip_count, sum(total_amount) AS total_amount
        FROM IDENTIFIER(:silver) WHERE year = :year AND month = :month GROUP BY pickup_location_id""",
    "06_broad_silver_scan": """
        SELECT sum(total_amount) AS total_amount, avg(trip_distance) AS avg_trip_distance,
               avg(trip_duration_min) AS avg_trip_duration_min
        FROM IDENTIFIER(:silver)""",
    "07_filtered_silver_scan": """
        SELECT sum(total_amount) AS total_amount, avg(trip_distance) AS avg_trip_distance,
               avg(trip_duration_min) AS avg_trip_duration_min
        FROM IDENTIFIER(:silver) WHERE year = :year AND month = :month""",
}
CORRECTNESS = {
    "01_partition_row_count": SUITE["01_partition_row_count"],
    # Latest row per check as a max_by aggregate (no window over the history).
    "02_quality_result_summary": """
        SELECT status, count(*) AS check_count FROM (
          SELECT check_name, max_by(status, struct(processed_at, dag_run_id)) AS status
          FROM IDENTIFIER(:quality) WHERE dataset = :dataset AND year = :year AND month = :month
          GROUP BY check_name)
        GROUP BY status ORDER BY status""",
    "03_gold_revenue_check": SUITE["03_gold_revenue_check"],
}
PERFORMANCE = {
    "01_partition_financial_aggregation": SUITE["04_partition_financial_aggregation"],
    "02_pickup_location_aggregation": SUITE["05_pickup_location_aggregation"],
    "03_dataset_financial_scan": SUITE["06_broad_silver_scan"],
}
SETS = {"plain": SUITE, "correctness": CORRECTNESS, "performance": PERFORMANCE}


def _bind(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> dict[str, str]:
    names = {}
    for role, t in tables.items():
        if isinstance(t, DataFrame):
            view = f"tollgate_{role}_{uuid.uuid4().hex[:8]}"
            t.createOrReplaceTempView(view)
            names[role] = view
        else:
            names[role] = t
    return names


def run_query(spark: SparkSession, name: str, tables: Mapping[str, DataFrame | str],
              dataset: str | None = None, year: int | None = None, month: int | None = None,
              run_id: str | None = None, suite: str = "plain") -> DataFrame:
    """Run one named query of a suite for one partition.

    ``tables`` maps the roles ``silver``, ``quality`` and ``gold`` to a
    DataFrame or a table name; only the roles the query uses are needed.
    """
    sql = SETS[suite][name]
    bound = _bind(spark, tables)
    values = {"dataset": dataset, "year": year, "month": month, "run_id": run_id}
    args: dict[str, object] = {r: v for r, v in bound.items() if f":{r}" in sql}
    args.update({k: v for k, v in values.items() if f":{k}" in sql})
    missing = [p for p in ("silver", "quality", "gold", "dataset", "year", "month", "run_id")
               if f":{p}" in sql and args.get(p) is None]
    if missing:
        raise ValueError(f"{suite}/{name} needs {missing}")
    return run_template(spark, sql, None, args)


def run_suite(spark: SparkSession, tables: Mapping[str, DataFrame | str], dataset: str, year: int,
              month: int, run_id: str | None = None, suite: str = "plain") -> dict[str, DataFrame]:
    """All queries of a suite for one partition (queries needing an absent
    table or run id are skipped)."""
    out = {}
    for name, sql in SETS[suite].items():
        if any(f":{r}" in sql and r not in tables for r in ("silver", "quality", "gold")):
            continue
        if ":run_id" in sql and run_id is None:
            continue
        out[name] = run_query(spark, name, tables, dataset, year, month, run_id, suite)
    return out
