"""Registered queries: validation rules, coverage, reconciliation, small marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollgate.functions.hashing import NULL_TOKEN
from tollgate.operators import coverage, marts, validation
from tollgate.operators.sequence import first_per_group, with_sequence
from tollgate.plans import oracle
from tollgate.plans.datasets import silver_all
from tollgate.plans.registry import register, rnd
from tollgate.plans.registry_evidence import EVIDENCE_SQL, _matched
from tollgate.plans.registry_metrics import ATTEMPTS_SQL, _rm, attempt_members, members_of
from tollgate.sources.adapters import TASK_IDS

PKEYS = ["dataset", "year", "month"]

# ---------------------------------------------------------------------------
# V7-V11, V13, V14
# ---------------------------------------------------------------------------

register("duplicate_keys", oracle.with_metrics(
    "SELECT query_id, count(*) AS occurrences FROM run_metrics WHERE query_id IS NOT NULL "
    "GROUP BY query_id HAVING count(*) > 1"))(
    lambda spark, sf: validation.duplicate_keys(_rm(spark, sf).where(F.col("query_id").isNotNull()), "query_id"))

register("write_consistency", oracle.with_metrics("""
SELECT architecture, table_name, dataset, year, month, count(*) AS writes,
       count(DISTINCT struct_pack(a := records_read, b := file_count)) AS versions
FROM run_metrics WHERE metric_type = 'iceberg_partition'
GROUP BY architecture, table_name, dataset, year, month
HAVING count(*) >= 2 AND count(DISTINCT struct_pack(a := records_read, b := file_count)) > 1"""))(
    lambda spark, sf: validation.write_inconsistencies(_rm(spark, sf)))

register("sequence_assigned", oracle.with_metrics(
    "SELECT metric_id, started_at, CAST(row_number() OVER (ORDER BY started_at, metric_id) AS INTEGER) "
    "AS sequence_position FROM run_metrics"))(
    lambda spark, sf: with_sequence(_rm(spark, sf).select("metric_id", "started_at"), ["started_at", "metric_id"]))

register("sequence_contiguity", oracle.with_metrics("""
SELECT comparison_id, min(sequence_position) AS min_position, max(sequence_position) AS max_position,
       count(sequence_position) AS positions, count(DISTINCT sequence_position) AS distinct_positions,
       (min(sequence_position) = 1 AND max(sequence_position) = count(sequence_position)
        AND count(DISTINCT sequence_position) = count(sequence_position)) AS contiguous
FROM run_metrics GROUP BY comparison_id"""))(
    lambda spark, sf: validation.sequence_gaps(_rm(spark, sf), by=["comparison_id"]))

_TASKS = ", ".join(f"'{t}'" for t in TASK_IDS)
V10_SQL = f"""
SELECT metric_id AS subject, 'query_id_required' AS rule FROM run_metrics
  WHERE metric_type = 'trino_query' AND coalesce(query_id, '') = ''
UNION ALL SELECT metric_id, 'query_finished' FROM run_metrics
  WHERE metric_type = 'trino_query' AND upper(coalesce(status, '')) <> 'FINISHED'
UNION ALL SELECT metric_id, 'pipeline_success' FROM run_metrics
  WHERE metric_type = 'pipeline' AND lower(coalesce(status, '')) <> 'success'
UNION ALL SELECT metric_id, 'spark_application_id_required' FROM run_metrics
  WHERE metric_type = 'airflow_task' AND task_id IN ({_TASKS}) AND coalesce(spark_application_id, '') = ''
UNION ALL SELECT metric_id, 'positive_duration' FROM run_metrics
  WHERE duration_seconds IS NOT NULL AND duration_seconds <= 0"""

register("required_fields", oracle.with_metrics(V10_SQL))(
    lambda spark, sf: validation.rule_violations(_rm(spark, sf)))

def _expected_n():
    return F.when(F.col("measurement_protocol") == "warm_recorded", F.lit(5)).otherwise(F.lit(3))
V11_KEYS = ["measurement_protocol", "architecture", "query_name", "dataset", "year", "month"]
V11_SQL = f"""
SELECT {', '.join(V11_KEYS)}, count(*) AS observed,
       CASE WHEN measurement_protocol = 'warm_recorded' THEN 5 ELSE 3 END AS expected
FROM run_metrics WHERE metric_type = 'trino_query'
  AND measurement_protocol IN ('warm_recorded', 'service_cold_recorded')
GROUP BY {', '.join(V11_KEYS)}
HAVING count(*) <> CASE WHEN measurement_protocol = 'warm_recorded' THEN 5 ELSE 3 END"""


def _v11(spark, sf):
    rm = _rm(spark, sf).where((F.col("metric_type") == "trino_query")
                              & F.col("measurement_protocol").isin("warm_recorded", "service_cold_recorded"))
    return validation.cardinality_violations(rm, V11_KEYS, _expected_n())


register("group_cardinality", oracle.with_metrics(V11_SQL))(_v11)

V13_SQL = ATTEMPTS_SQL + """,
recorded AS (SELECT benchmark_run_id, 'spark.cores.max' AS key, CAST(repetition * 4 AS VARCHAR) AS value
             FROM run_metrics WHERE metric_type = 'airflow_task'),
scheduled AS (SELECT DISTINCT benchmark_run_id, 'spark.cores.max' AS key, '8' AS value FROM members)"""


def _v13(spark, sf):
    rm = _rm(spark, sf)
    recorded = rm.where(F.col("metric_type") == "airflow_task").select(
        "benchmark_run_id", F.lit("spark.cores.max").alias("key"), (F.col("repetition") * 4).cast("string").alias("value"))
    scheduled = members_of(rm).select("benchmark_run_id", F.lit("spark.cores.max").alias("key"),
                                      F.lit("8").alias("value")).distinct()
    return validation.config_mismatches(recorded, scheduled)


register("applied_config", oracle.with_metrics("""
SELECT s.benchmark_run_id, s.key, s.value AS scheduled_value, r.value AS recorded_value
FROM scheduled s LEFT JOIN recorded r ON s.benchmark_run_id = r.benchmark_run_id AND s.key = r.key
WHERE r.value IS NULL OR r.value <> s.value""", V13_SQL))(_v13)


def _verdict(spark, sf):
    rm = _rm(spark, sf)
    return validation.verdict([
        validation.duplicate_keys(rm.where(F.col("query_id").isNotNull()), "query_id"),
        validation.rule_violations(rm),
        _v11(spark, sf),
    ])


register("verdict", oracle.with_metrics(f"""
SELECT n AS violations, CASE WHEN n > 0 THEN '{validation.BLOCKED}' ELSE '{validation.READY}' END AS status
FROM (SELECT (SELECT count(*) FROM (SELECT query_id FROM run_metrics WHERE query_id IS NOT NULL
                                    GROUP BY query_id HAVING count(*) > 1))
           + (SELECT count(*) FROM ({V10_SQL}))
           + (SELECT count(*) FROM ({V11_SQL})) AS n)"""))(_verdict)


# ---------------------------------------------------------------------------
# coverage grid, expected counts, progress
# ---------------------------------------------------------------------------

# The design of the comparison (executions per protocol,
# trials, cells).
DESIGN_PROTOCOLS = {"warmup": 1, "warm_recorded": 5, "service_cold_recorded": 3}
DESIGN_TRIALS = 3
DESIGN_CELLS = [("onprem", "fragmented"), ("onprem", "compact"),
                ("hybrid_aws", "fragmented"), ("hybrid_aws", "compact")]
TARGET_COLS = ["query_name", "dataset", "year", "month"]


def _grid(spark, sf):
    targets = _rm(spark, sf).where(F.col("metric_type") == "trino_query").select(*TARGET_COLS).distinct()
    return coverage.coverage_grid(targets, DESIGN_PROTOCOLS, DESIGN_TRIALS, DESIGN_CELLS)


_PROTO_VALUES = ", ".join(f"('{p}', {n})" for p, n in DESIGN_PROTOCOLS.items())
_CELL_VALUES = ", ".join(f"('{a}', '{l}')" for a, l in DESIGN_CELLS)
GRID_SQL = f"""
targets AS (SELECT DISTINCT {', '.join(TARGET_COLS)} FROM run_metrics WHERE metric_type = 'trino_query'),
grid AS (
  SELECT t.*, tr.trial, p.protocol, e.execution, c.architecture, c.layout
  FROM targets t, (SELECT unnest(range(1, {DESIGN_TRIALS} + 1)) AS trial) tr,
       (VALUES {_PROTO_VALUES}) p(protocol, executions),
       LATERAL (SELECT unnest(range(1, p.executions + 1)) AS execution) e,
       (VALUES {_CELL_VALUES}) c(architecture, layout)
)"""

KEY = [*TARGET_COLS, "protocol", "architecture", "layout"]


def _observed(spark, sf):
    return _rm(spark, sf).where(F.col("metric_type") == "trino_query").select(
        *TARGET_COLS, F.col("measurement_protocol").alias("protocol"), "architecture",
        F.col("file_layout").alias("layout"))


register("coverage_gaps", oracle.with_metrics(f"""
SELECT *, 'missing' AS gap FROM (SELECT DISTINCT {', '.join(KEY)} FROM grid
  EXCEPT SELECT DISTINCT {', '.join(TARGET_COLS)}, measurement_protocol, architecture, file_layout
         FROM run_metrics WHERE metric_type = 'trino_query')
UNION ALL
SELECT *, 'unexpected' AS gap FROM (SELECT DISTINCT {', '.join(TARGET_COLS)}, measurement_protocol, architecture, file_layout
         FROM run_metrics WHERE metric_type = 'trino_query'
  EXCEPT SELECT DISTINCT {', '.join(KEY)} FROM grid)""", GRID_SQL))(
    lambda spark, sf: coverage.coverage_gaps(_grid(spark, sf), _observed(spark, sf), KEY))

EXPECTED_SQL = f"""SELECT count(DISTINCT ({', '.join(TARGET_COLS)}, trial, protocol, execution)) AS expected_pairs,
       count(*) AS expected_members FROM grid"""

register("expected_counts", oracle.with_metrics(EXPECTED_SQL, GRID_SQL))(
    lambda spark, sf: coverage.expected_counts(_grid(spark, sf), TARGET_COLS))

register("run_progress", oracle.with_metrics(f"""
SELECT e.expected_pairs, a.scheduled_pairs, a.completed_pairs, a.failed_pairs, e.expected_members,
       m.scheduled_members, m.completed_members, m.running_members,
       CASE WHEN e.expected_members > 0 THEN round(m.completed_members / e.expected_members * 100, 6) ELSE 0.0 END AS progress_percent
FROM (SELECT count(*) AS scheduled_pairs,
             CAST(sum(CASE WHEN attempt_status = 'complete' THEN 1 ELSE 0 END) AS BIGINT) AS completed_pairs,
             CAST(sum(CASE WHEN attempt_status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_pairs
      FROM (SELECT DISTINCT pair_id, attempt, attempt_status FROM attempt_members)) a,
     (SELECT count(*) AS scheduled_members,
             CAST(sum(CASE WHEN attempt_status = 'complete' THEN 1 ELSE 0 END) AS BIGINT) AS completed_members,
             CAST(sum(CASE WHEN attempt_status = 'running' THEN 1 ELSE 0 END) AS BIGINT) AS running_members
      FROM attempt_members) m,
     ({EXPECTED_SQL}) e""", ATTEMPTS_SQL + "," + GRID_SQL))(
    lambda spark, sf: rnd(coverage.run_progress(
        attempt_members(_rm(spark, sf)), coverage.expected_counts(_grid(spark, sf), TARGET_COLS)),
        {"progress_percent": 6}))


# ---------------------------------------------------------------------------
# J8, J9
# ---------------------------------------------------------------------------

def _j8(spark, sf):
    rm = _rm(spark, sf)
    artifact = rm.where(F.col("metric_type") != "iceberg_partition")
    table = rm.where(F.col("status") != "FAILED")
    return coverage.reconcile_ids(artifact, table, "metric_id")


register("id_reconciliation", oracle.with_metrics("""
SELECT coalesce(a.metric_id, t.metric_id) AS metric_id,
       CASE WHEN a.metric_id IS NULL THEN 'only_table' ELSE 'only_artifact' END AS side
FROM (SELECT DISTINCT metric_id FROM run_metrics WHERE metric_type <> 'iceberg_partition') a
FULL OUTER JOIN (SELECT DISTINCT metric_id FROM run_metrics WHERE status <> 'FAILED') t
  ON a.metric_id = t.metric_id
WHERE a.metric_id IS NULL OR t.metric_id IS NULL"""))(_j8)


def _j9(spark, sf):
    s = silver_all(spark, sf)
    gold = marts.monthly_revenue(s).select(*PKEYS, "trip_count", "total_amount_sum")
    fin = marts.financial_aggregate(s).join(marts.row_count(s), PKEYS).select(
        *PKEYS, F.col("row_count").alias("trip_count"), F.col("total_amount").alias("total_amount_sum"))
    return coverage.results_equivalent(gold, fin, PKEYS).select(*PKEYS, "mismatch", "column")


_REV = "(is_valid_trip = true AND fare_amount > 0 AND total_amount > 0)"
register("results_equivalent", oracle.with_silver(f"""
SELECT g.dataset, g.year, g.month, 'value' AS mismatch, 'total_amount_sum' AS "column"
FROM (SELECT dataset, year, month, coalesce(sum(CASE WHEN {_REV} THEN CAST(total_amount AS DOUBLE) END), 0.0) AS v
      FROM silver_all GROUP BY ALL) g
JOIN (SELECT dataset, year, month, sum(total_amount) AS v FROM silver_all GROUP BY ALL) f
  USING (dataset, year, month)
WHERE NOT (abs(g.v - f.v) <= greatest(1e-9 * greatest(abs(g.v), abs(f.v)), 1e-6))"""))(_j9)


def _nested(spark, sf):
    """Duration profiles per (metric type or NULL, architecture): nested values under a key that may be NULL."""
    key = F.when(F.col("metric_type") != "airflow_task", F.col("metric_type")).alias("kind")
    d = F.col("duration_seconds")
    return _rm(spark, sf).where(d.isNotNull()).groupBy(key, "query_name", "architecture").agg(
        F.struct(F.count(d).alias("n"), F.array(F.min(d), F.max(d)).alias("range")).alias("spread"),
        F.create_map(F.lit("least"), F.min(d), F.lit("most"), F.max(d)).alias("ends"))


def _results_nested(spark, sf):
    a = _nested(spark, sf)
    jitter = lambda x: x * (1 + 1e-12)  # noqa: E731 - within tolerance at any depth
    b = a.where("kind IS NOT NULL OR architecture = 'onprem'").select(
        "kind", "query_name", "architecture",
        F.struct(F.col("spread.n").alias("n"), F.transform("spread.range", jitter).alias("range")).alias("spread"),
        F.when(F.col("architecture") == "onprem", F.transform_values("ends", lambda k, v: F.when(k == "most", v + 1).otherwise(v)))
        .otherwise(F.transform_values("ends", lambda k, v: jitter(v))).alias("ends"))
    return coverage.results_equivalent(a, b, ["kind", "query_name", "architecture"]).select("kind", "query_name", "architecture", "mismatch", "column")


register("results_nested", oracle.with_metrics("""
SELECT kind, query_name, architecture, CASE WHEN architecture = 'onprem' THEN 'value' ELSE 'missing_right' END AS mismatch,
       CASE WHEN architecture = 'onprem' THEN 'ends' END AS "column"
FROM (SELECT DISTINCT CASE WHEN metric_type <> 'airflow_task' THEN metric_type END AS kind, query_name, architecture
      FROM run_metrics WHERE duration_seconds IS NOT NULL)
WHERE architecture = 'onprem' OR kind IS NULL"""))(_results_nested)


def _row_mismatches(spark, sf):
    """Gold without its keys against a copy with rounding noise in every row, a changed January and no December."""
    a = marts.monthly_revenue(silver_all(spark, sf)).select("dataset", "trip_count", "month", "total_amount_sum", "avg_trip_distance")
    b = a.where("month <> 12").select("dataset", "trip_count", "month", (F.col("total_amount_sum") * (1 + 1e-13)).alias("total_amount_sum"),
                                      F.when(F.col("month") == 1, F.col("avg_trip_distance") + 1).otherwise(F.col("avg_trip_distance")).alias("avg_trip_distance"))
    return coverage.row_mismatches(a, b).groupBy("mismatch", "column").agg(F.count(F.lit(1)).alias("rows"))


register("row_mismatches", oracle.with_silver("""
SELECT CASE WHEN month = 1 THEN 'value' ELSE 'missing_right' END AS mismatch, CASE WHEN month = 1 THEN 'avg_trip_distance' END AS "column", count(*) AS rows
FROM (SELECT DISTINCT dataset, year, month FROM silver_all WHERE month IN (1, 12)) GROUP BY ALL"""))(_row_mismatches)


# ---------------------------------------------------------------------------
# W2, P18, A10, A11, A20, J14, A21
# ---------------------------------------------------------------------------

def _parts(spark, sf):
    return silver_all(spark, sf).select(*PKEYS).distinct()


register("first_partition", oracle.with_silver(
    "SELECT dataset, arg_min(year, year * 100 + month) AS year, arg_min(month, year * 100 + month) AS month "
    "FROM (SELECT DISTINCT dataset, year, month FROM silver_all) GROUP BY dataset"))(
    lambda spark, sf: first_per_group(_parts(spark, sf), ["dataset"], ["year", "month"]))

register("select_partitions", oracle.with_silver(
    "SELECT DISTINCT dataset, year, month FROM silver_all WHERE dataset = 'yellow'"))(
    lambda spark, sf: coverage.select_partitions(_parts(spark, sf), dataset="yellow"))

register("metrics_by_type", oracle.with_metrics(
    "SELECT architecture, environment, metric_type, count(*) AS metric_count FROM run_metrics "
    "GROUP BY ALL ORDER BY ALL"))(lambda spark, sf: marts.metrics_by_type(_rm(spark, sf)))

PROFILE_COLS = ["vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance",
                "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id", "fare_amount",
                "tip_amount", "tolls_amount", "total_amount", "trip_duration_min", "is_valid_trip",
                "has_tip", "tip_ratio"]
_TEXT = {"pickup_ts": "CAST(epoch_us(pickup_ts) AS VARCHAR)", "dropoff_ts": "CAST(epoch_us(dropoff_ts) AS VARCHAR)"}
for _c in ("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
           "trip_duration_min", "tip_ratio"):
    _TEXT[_c] = f"CAST(CAST({_c} AS DECIMAL(38,6)) AS VARCHAR)"
_CANON = ", ".join(f"coalesce({_TEXT.get(c, f'CAST({c} AS VARCHAR)')}, '{NULL_TOKEN}')" for c in PROFILE_COLS)

register("content_profile", oracle.with_silver(f"""
SELECT dataset, year, month, count(*) AS row_count,
       {', '.join(f'CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_{c}' for c in PROFILE_COLS)},
       CAST(sum(CAST(CAST(concat('0x', substr(md5(concat_ws('|', {_CANON})), 1, 15)) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR)
         AS content_checksum
FROM silver_all GROUP BY dataset, year, month"""))(
    lambda spark, sf: marts.content_profile(silver_all(spark, sf).select(*PKEYS, *PROFILE_COLS), portable=True))

PROFILES_SQL = """
runs AS (SELECT dataset AS workload_name,
                ['small', 'medium', 'default'][CAST(regexp_extract(dag_run_id, '[0-9]+') AS BIGINT) % 3 + 1] AS profile,
                duration_seconds
         FROM run_metrics WHERE metric_type = 'pipeline'),
med AS (SELECT workload_name, profile, count(duration_seconds) AS n, min(duration_seconds) AS min_seconds,
               quantile_cont(duration_seconds, 0.5) AS median_seconds, max(duration_seconds) AS max_seconds
        FROM runs GROUP BY ALL)"""


def _profiles(spark, sf):
    rm = _rm(spark, sf).where(F.col("metric_type") == "pipeline")
    idx = (F.regexp_extract("dag_run_id", "[0-9]+", 0).cast("bigint") % 3 + 1).cast("int")
    prof = F.element_at(F.array(F.lit("small"), F.lit("medium"), F.lit("default")), idx)
    return coverage.profile_medians(rm.select(F.col("dataset").alias("workload_name"), prof.alias("profile"),
                                              "duration_seconds"))


register("profile_medians", oracle.with_metrics(
    "SELECT workload_name, profile, n, round(min_seconds, 6) AS min_seconds, round(median_seconds, 6) AS median_seconds, "
    "round(max_seconds, 6) AS max_seconds FROM med", PROFILES_SQL))(
    lambda spark, sf: rnd(_profiles(spark, sf), {"min_seconds": 6, "median_seconds": 6, "max_seconds": 6}))

register("profile_gain", oracle.with_metrics("""
SELECT workload_name, round(small, 6) AS small, round(medium, 6) AS medium, round("default", 6) AS "default",
       round((small - medium) / small * 100, 6) AS small_to_medium_gain_percent,
       round((medium - "default") / medium * 100, 6) AS medium_to_default_gain_percent
FROM (SELECT workload_name, max(CASE WHEN profile = 'small' THEN median_seconds END) AS small,
             max(CASE WHEN profile = 'medium' THEN median_seconds END) AS medium,
             max(CASE WHEN profile = 'default' THEN median_seconds END) AS "default"
      FROM med GROUP BY workload_name)
WHERE small IS NOT NULL AND medium IS NOT NULL AND "default" IS NOT NULL""", PROFILES_SQL))(
    lambda spark, sf: rnd(coverage.profile_gain(_profiles(spark, sf)),
                          {c: 6 for c in ("small", "medium", "default", "small_to_medium_gain_percent",
                                          "medium_to_default_gain_percent")}))

register("prep_time_summary", oracle.with_metrics("""
SELECT architecture || ':' || file_layout AS cell, count(duration_seconds) AS n,
       round(quantile_cont(duration_seconds, 0.5), 6) AS median, round(quantile_cont(duration_seconds, 0.25), 6) AS q1,
       round(quantile_cont(duration_seconds, 0.75), 6) AS q3,
       round(quantile_cont(duration_seconds, 0.75) - quantile_cont(duration_seconds, 0.25), 6) AS iqr,
       round(quantile_cont(duration_seconds, 0.95), 6) AS p95, 'descriptive_only' AS claim
FROM run_metrics WHERE metric_type = 'iceberg_partition' GROUP BY ALL"""))(
    lambda spark, sf: rnd(coverage.prep_time_summary(_rm(spark, sf).where(F.col("metric_type") == "iceberg_partition").select(
        F.concat_ws(":", "architecture", "file_layout").alias("cell"), F.col("duration_seconds").alias("elapsed_seconds"))),
        {c: 6 for c in ("median", "q1", "q3", "iqr", "p95")}))


# ---------------------------------------------------------------------------
# V12 evidence gaps, P19 metric selection
# ---------------------------------------------------------------------------

def _v12(spark, sf):
    from tollgate.operators.evidence import window_completeness
    from tollgate.sources.adapters import request_windows, resource_samples

    rm = _rm(spark, sf)
    samples = resource_samples(spark, sf).select(
        "benchmark_run_id", (F.col("cpu_percent") < 0.2).alias("is_error"))
    windows = window_completeness(request_windows(rm), _matched(spark, sf))
    return validation.evidence_gaps(samples, members_of(rm), windows)


register("evidence_gaps", oracle.with_metrics("""
SELECT benchmark_run_id AS subject, 'resource_samples_missing' AS rule, '0' AS observed
FROM (SELECT DISTINCT m.benchmark_run_id FROM members m LEFT JOIN s ON m.benchmark_run_id = s.benchmark_run_id
      WHERE coalesce(s.samples, 0) = 0)
UNION ALL
SELECT m.benchmark_run_id, 'resource_sampling_errors', CAST(s.errors AS VARCHAR)
FROM (SELECT DISTINCT benchmark_run_id FROM members) m JOIN s ON m.benchmark_run_id = s.benchmark_run_id
WHERE s.errors > 0
UNION ALL
SELECT w.block, 'request_datapoints_missing', '0' FROM windows w
WHERE w.block NOT IN (SELECT DISTINCT block FROM matched)""", ATTEMPTS_SQL, """
s AS (SELECT 'run-' || CAST(user_id AS VARCHAR) || '-' || CASE WHEN event_id % 2 = 0 THEN 'onprem' ELSE 'hybrid_aws' END
             AS benchmark_run_id,
             CAST(sum(CASE WHEN value / 5 < 0.2 THEN 0 ELSE 1 END) AS BIGINT) AS samples,
             CAST(sum(CASE WHEN value / 5 < 0.2 THEN 1 ELSE 0 END) AS BIGINT) AS errors
      FROM events GROUP BY 1)""", EVIDENCE_SQL))(_v12)


def _p19(spark, sf):
    from tollgate.sources.adapters import BROAD_QUERY, FILTERED_QUERY

    sel, bad = coverage.select_metrics(_rm(spark, sf), ["warm_recorded", "service_cold_recorded"],
                                       [FILTERED_QUERY, BROAD_QUERY])
    return bad.select("metric_id", "measurement_protocol", "query_name", "status")


register("metric_selection_failures", oracle.with_metrics("""
SELECT metric_id, measurement_protocol, query_name, status FROM run_metrics
WHERE metric_type = 'trino_query' AND measurement_protocol IN ('warm_recorded', 'service_cold_recorded')
  AND query_name IN ('01_partition_financial_aggregation', '03_dataset_financial_scan')
  AND coalesce(status, '') <> 'FINISHED'"""))(_p19)
