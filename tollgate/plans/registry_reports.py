"""Registered queries: the composite reports (C6, C7, C9), run status (A22), cost total (J11), properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollgate.operators import coverage, evidence, validation
from tollgate.plans import oracle, reports
from tollgate.plans.registry import register, rnd
from tollgate.plans.registry_evidence import EVIDENCE_SQL, RATES_SQL, _rates, _totals
from tollgate.plans.registry_metrics import ATTEMPTS_SQL, _rm, attempt_members
from tollgate.plans.registry_validation import V10_SQL

# ---------------------------------------------------------------------------
# Cost in all
# ---------------------------------------------------------------------------


def _cost_total(spark, sf):
    """PUT requests left out of the usage (their row is 0) and GET out of the rates (a missing one)."""
    usage = _totals(spark, sf).withColumnRenamed("total", "quantity").where("metric <> 'PutRequests'")
    out = evidence.cost_total(evidence.cost_estimate(usage, _rates(spark, sf).where("rate_name <> 'get_requests'")))
    return rnd(out, {"estimated_usd": 6}).withColumn("missing_rates", F.array_join("missing_rates", ","))


register("cost_total", oracle.with_metrics("""
SELECT round(sum(CAST(value AS DECIMAL(38,6))) / 1073741824.0 * (SELECT usd FROM rates WHERE rate_name = 'bytes_downloaded'), 6) AS estimated_usd,
       'get_requests' AS missing_rates
FROM matched WHERE metric = 'BytesDownloaded'""", EVIDENCE_SQL, RATES_SQL))(_cost_total)

# ---------------------------------------------------------------------------
# Completeness rules
# ---------------------------------------------------------------------------


def _comparison(spark, sf):
    """Every user is a scheduled pair; artifacts lack the metrics of one task; results are row counts per key."""
    rm = _rm(spark, sf)
    expected = rm.select(F.col("dag_run_id").alias("pair_id"))
    artifacts = rm.where(~F.col("task_id").eqNullSafe(F.lit("stage_trips")))
    results = rm.where(F.col("metric_type") == "iceberg_partition").groupBy(
        F.concat_ws("/", "dataset", "year", "month", "file_layout").alias("run_key"), "architecture").agg(F.max("file_count").alias("result"))
    return reports.comparison_violations(rm, attempt_members(rm), expected, artifacts, results)


COMPARISON_SQL = ATTEMPTS_SQL + f""",
runs AS (SELECT DISTINCT benchmark_run_id, architecture, protocol FROM members),
of_runs AS (SELECT r.* FROM run_metrics r WHERE benchmark_run_id IN (SELECT benchmark_run_id FROM runs)),
found AS (
  SELECT pair_id AS subject, 'complete_attempts' AS rule, format('expected one complete attempt, found {{:d}}', complete_attempts) AS observed
  FROM per_pair WHERE complete_attempts <> 1
  UNION ALL SELECT metric_id, 'duplicate_metric_id', CAST(count(*) AS VARCHAR) FROM run_metrics GROUP BY metric_id HAVING count(*) > 1
  UNION ALL SELECT query_id, 'duplicate_query_id', CAST(count(*) AS VARCHAR) FROM run_metrics
    WHERE metric_type = 'trino_query' AND query_id <> '' GROUP BY query_id HAVING count(*) > 1
  UNION ALL SELECT subject, rule, '' FROM ({V10_SQL.replace("FROM run_metrics", "FROM of_runs")})
  UNION ALL SELECT concat_ws('/', architecture, table_name, dataset, CAST(year AS VARCHAR), CAST(month AS VARCHAR)), 'repeated_write_changed',
    CAST(count(DISTINCT struct_pack(a := records_read, b := file_count)) AS VARCHAR)
    FROM of_runs WHERE metric_type = 'iceberg_partition' AND measurement_protocol = 'pipeline_paired'
    GROUP BY architecture, table_name, dataset, year, month
    HAVING count(*) >= 2 AND count(DISTINCT struct_pack(a := records_read, b := file_count)) > 1
  UNION ALL SELECT DISTINCT dag_run_id, 'pair_missing', '' FROM run_metrics WHERE dag_run_id NOT IN (SELECT pair_id FROM members)
  UNION ALL SELECT benchmark_run_id, 'artifact_ids_differ', CAST(count(DISTINCT metric_id) AS VARCHAR)
    FROM of_runs WHERE task_id = 'stage_trips' GROUP BY benchmark_run_id
  UNION ALL SELECT run_key, 'results_differ', count(*) || '/' || count(DISTINCT result) FROM (
      SELECT concat_ws('/', dataset, CAST(year AS VARCHAR), CAST(month AS VARCHAR), file_layout) AS run_key, architecture, max(file_count) AS result
      FROM run_metrics WHERE metric_type = 'iceberg_partition' GROUP BY ALL)
    GROUP BY run_key HAVING count(*) < 2 OR count(DISTINCT result) > 1
)"""

register("comparison_violations", oracle.with_metrics("SELECT * FROM found", COMPARISON_SQL))(_comparison)

register("comparison_verdict", oracle.with_metrics(
    f"SELECT count(*) AS violations, CASE WHEN count(*) > 0 THEN '{validation.BLOCKED}' ELSE '{validation.READY}' END AS status FROM found",
    COMPARISON_SQL))(lambda spark, sf: validation.verdict([_comparison(spark, sf)]))

# ---------------------------------------------------------------------------
# Cardinality of the 2x2 design
# ---------------------------------------------------------------------------


def _layout_members(rm):
    """One member per run of a trial; its position is the first one that its metrics hold."""
    return rm.groupBy(F.col("trial_id").alias("pair_id"), "architecture", F.col("file_layout").alias("layout"), "benchmark_run_id").agg(
        F.min("sequence_position").alias("sequence_position"),
        F.when(F.count_if(F.col("status") == "FAILED") > 2, "failed").otherwise("complete").alias("status"))


def _layout_violations(spark, sf):
    rm = _rm(spark, sf)
    scheduled = rm.where(F.col("measurement_protocol") != "pipeline_paired").select(F.col("trial_id").alias("pair_id"))
    return reports.layout_member_violations(rm, _layout_members(rm), scheduled)


register("layout_member_violations", oracle.with_metrics("""
SELECT pair_id AS subject, 'pair_cells' AS rule, count(*) || '/' || count(DISTINCT (architecture, layout)) AS observed
FROM lm GROUP BY pair_id HAVING count(*) <> 4 OR count(DISTINCT (architecture, layout)) <> 4
UNION ALL SELECT benchmark_run_id, 'duplicate_run_id', CAST(count(*) AS VARCHAR) FROM lm GROUP BY benchmark_run_id HAVING count(*) > 1
UNION ALL SELECT benchmark_run_id, 'member_incomplete', status FROM lm WHERE status <> 'complete'
UNION ALL SELECT benchmark_run_id, 'query_metrics_missing', '' FROM lm
  WHERE benchmark_run_id NOT IN (SELECT benchmark_run_id FROM run_metrics WHERE metric_type = 'trino_query')
UNION ALL SELECT 'members', 'sequence_positions', CAST(count(*) AS VARCHAR) FROM lm
  HAVING NOT (min(sequence_position) = 1 AND max(sequence_position) = count(*) AND count(DISTINCT sequence_position) = count(*))
UNION ALL SELECT DISTINCT trial_id, 'pair_unexpected', '' FROM run_metrics
  WHERE trial_id NOT IN (SELECT trial_id FROM run_metrics WHERE measurement_protocol <> 'pipeline_paired')""", """
lm AS (SELECT trial_id AS pair_id, architecture, file_layout AS layout, benchmark_run_id, min(sequence_position) AS sequence_position,
              CASE WHEN sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) > 2 THEN 'failed' ELSE 'complete' END AS status
       FROM run_metrics GROUP BY ALL)"""))(_layout_violations)

# ---------------------------------------------------------------------------
# Executor sizing
# ---------------------------------------------------------------------------

_PROFILES = ("small", "medium", "default")


def _sizing(spark, sf):
    """Profile by user mod 3, workload by dataset; a member per run.  Property lists
    repeat spark.cores.max (the last counts) and may lack spark.executor.cores."""
    rm = _rm(spark, sf)
    user = F.regexp_extract("benchmark_run_id", "run-([0-9]+)-", 1).cast("bigint")
    profile = F.element_at(F.array(*map(F.lit, _PROFILES)), (user % 3 + 1).cast("int"))
    cores = (user % 3 + 1) * 4
    runs = rm.groupBy(F.col("trial_id").alias("pair_id"), F.col("dataset").alias("workload_name"), "architecture", "benchmark_run_id").agg(
        F.min("sequence_position").alias("sequence_position"), F.count_if(F.col("status") == "FAILED").alias("_failed"))
    key = F.concat_ws(":", "architecture", F.col("layout")).alias("profile")
    runs = runs.withColumns({"size": profile, "layout": F.concat_ws("-", profile, user.cast("string")), "cores_max": cores,
                             "executor_cores": F.lit(2).cast("bigint")})
    schedule = runs.where(user % 7 != 0).select("pair_id", key, "workload_name", "size", "cores_max",
                                                 F.when(user % 5 == 0, 4).otherwise(2).cast("bigint").alias("executor_cores"), "sequence_position")
    members = runs.where(user % 11 != 0).select("pair_id", key, "benchmark_run_id", "cores_max", "executor_cores", "sequence_position",
                                                F.when(F.col("_failed") > 2, "failed").otherwise("complete").alias("status"))
    pair = lambda k, v: F.array(F.lit(k), v.cast("string"))
    maxes = [pair("spark.cores.max", F.lit(0)), pair("spark.cores.max", F.col("repetition") * 4)]
    listed = F.when(F.col("repetition") == 3, F.array(*maxes)).otherwise(F.array(*maxes, pair("spark.executor.cores", F.lit(2))))
    return schedule, members, rm.withColumn("spark_properties", listed), rm.where(F.col("metric_type") != "iceberg_partition")


SIZING_SQL = """
sizing AS (
  SELECT *, user % 3 AS p, architecture || ':' || CASE user % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' ELSE 'default' END || '-' || user AS profile,
         (user % 3 + 1) * 4 AS cores_max
  FROM (SELECT trial_id AS pair_id, dataset AS workload_name, architecture, benchmark_run_id,
               CAST(regexp_extract(benchmark_run_id, 'run-([0-9]+)-', 1) AS BIGINT) AS user, min(sequence_position) AS sequence_position,
               sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS failed
        FROM run_metrics GROUP BY ALL)),
sm AS (SELECT * FROM sizing WHERE user % 11 <> 0),
runs AS (
  SELECT sm.*, coalesce(tasks, 0) AS tasks, coalesce(pipelines, 0) AS pipelines, coalesce(successes, 0) AS successes, duration_seconds
  FROM sm LEFT JOIN (
    SELECT benchmark_run_id, sum(CASE WHEN metric_type = 'airflow_task' THEN 1 ELSE 0 END) AS tasks,
           sum(CASE WHEN metric_type = 'pipeline' THEN 1 ELSE 0 END) AS pipelines,
           sum(CASE WHEN metric_type = 'pipeline' AND status = 'success' THEN 1 ELSE 0 END) AS successes,
           max(CASE WHEN metric_type = 'pipeline' THEN duration_seconds END) AS duration_seconds
    FROM run_metrics GROUP BY benchmark_run_id) m ON sm.benchmark_run_id = m.benchmark_run_id),
applied AS (
  SELECT metric_id, r.benchmark_run_id, 'spark.cores.max' AS key, CAST(cores_max AS VARCHAR) AS scheduled_value, CAST(repetition * 4 AS VARCHAR) AS recorded_value
  FROM run_metrics r JOIN sm ON r.benchmark_run_id = sm.benchmark_run_id WHERE metric_type = 'airflow_task' AND repetition * 4 <> cores_max
  UNION ALL SELECT metric_id, r.benchmark_run_id, 'spark.executor.cores', '2', NULL
  FROM run_metrics r JOIN sm ON r.benchmark_run_id = sm.benchmark_run_id WHERE metric_type = 'airflow_task' AND repetition = 3),
found AS (
  SELECT pair_id || '/' || profile AS subject, 'member_missing' AS rule, '' AS observed FROM sizing WHERE user % 11 = 0 AND user % 7 <> 0
  UNION ALL SELECT pair_id || '/' || profile, 'member_unexpected', '' FROM sizing WHERE user % 11 <> 0 AND user % 7 = 0
  UNION ALL SELECT pair_id || '/' || profile, 'schedule_executor_cores', '2' FROM sizing WHERE user % 11 <> 0 AND user % 7 <> 0 AND user % 5 = 0
  UNION ALL SELECT pair_id || '/' || profile, 'member_incomplete', 'failed' FROM sm WHERE failed > 2
  UNION ALL SELECT benchmark_run_id, 'task_metrics', CAST(CAST(tasks AS BIGINT) AS VARCHAR) FROM runs WHERE tasks <> 3
  UNION ALL SELECT benchmark_run_id, 'pipeline_metric', CAST(successes AS BIGINT) || '/' || CAST(pipelines AS BIGINT) FROM runs
    WHERE pipelines <> 1 OR successes <> 1
  UNION ALL SELECT metric_id, 'not_applied:' || key, coalesce(recorded_value, '') FROM applied
  UNION ALL SELECT metric_id, 'metric_id_only_table', '' FROM run_metrics WHERE metric_type = 'iceberg_partition'
)"""


def _properties(spark, sf):
    _, members, metrics, _ = _sizing(spark, sf)
    scheduled = members.select("benchmark_run_id", F.inline(F.array(
        F.struct(F.lit("spark.cores.max").alias("key"), F.col("cores_max").cast("string").alias("value")),
        F.struct(F.lit("spark.executor.cores").alias("key"), F.col("executor_cores").cast("string").alias("value")))))
    return validation.property_mismatches(metrics.where(F.col("metric_type") == "airflow_task"), scheduled)


register("applied_properties", oracle.with_metrics("SELECT * FROM applied", SIZING_SQL))(_properties)

register("sizing_violations", oracle.with_metrics("SELECT * FROM found", SIZING_SQL))(
    lambda spark, sf: reports.executor_sizing_report(*_sizing(spark, sf))["violations"])

register("sizing_verdict", oracle.with_metrics(
    f"SELECT count(*) AS violations, CASE WHEN count(*) > 0 THEN '{validation.INVALID}' ELSE '{validation.READY}' END AS status FROM found",
    SIZING_SQL))(lambda spark, sf: reports.executor_sizing_report(*_sizing(spark, sf))["verdict"])

register("sizing_medians", oracle.with_metrics("""
SELECT workload_name, profile, count(*) AS n, round(min(duration_seconds), 6) AS min_seconds,
       round(quantile_cont(duration_seconds, 0.5), 6) AS median_seconds, round(max(duration_seconds), 6) AS max_seconds
FROM runs WHERE pipelines = 1 AND successes = 1 AND user % 7 <> 0 GROUP BY workload_name, profile""", SIZING_SQL))(
    lambda spark, sf: rnd(reports.executor_sizing_report(*_sizing(spark, sf))["medians"],
                          {c: 6 for c in ("min_seconds", "median_seconds", "max_seconds")}))

# ---------------------------------------------------------------------------
# Status of many runs
# ---------------------------------------------------------------------------


def _run_status(spark, sf):
    """A run per trial: its state comes from the number of its block, its attempts from the retries."""
    rm = _rm(spark, sf).drop("comparison_id").withColumnRenamed("trial_id", "comparison_id")
    block = F.regexp_extract("comparison_id", "trial-([0-9]+)", 1).cast("bigint")
    status = F.element_at(F.array(*map(F.lit, ("complete", "invalid", "running", "running", "paused", "failed"))), (block % 6 + 1).cast("int"))
    states = rm.groupBy("comparison_id").agg(F.min("started_at").alias("created_at"), F.max("finished_at").alias("_end")).select(
        "comparison_id", status.alias("status"), (block % 6 == 2).alias("runner_active"), "created_at",
        F.when(block % 6 != 4, F.col("_end")).alias("finished_at"))
    # NULL member status: an attempt whose only metrics failed reported no member.
    members = rm.groupBy("comparison_id", F.col("dag_run_id").alias("pair_id"), F.col("retry_count").alias("attempt"), "benchmark_run_id").agg(
        F.max("sequence_position").alias("position"), F.max("retry_count").alias("_retry"),
        F.min("status").alias("_least")).select(
        "comparison_id", "pair_id", "attempt", "position",
        F.when(F.col("_retry") == 1, "complete").otherwise("failed").alias("attempt_status"),
        F.when(F.col("_least") == "FINISHED", "running").when(F.col("_least") == "success", "complete").when(F.col("position") % 2 == 0, "failed").alias("member_status"))
    expected = states.where(block % 5 != 0).select("comparison_id", (block % 4).alias("expected_pairs"), ((block % 4) * 2).alias("expected_members"))
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    return rnd(coverage.run_status(states, members, expected, now=now), {"progress_percent": 6, "elapsed_seconds": 6})


register("run_status", oracle.with_metrics("""
SELECT comparison_id, state_status, result,
       CASE result WHEN 'complete' THEN 0 WHEN 'running' THEN 1 WHEN 'invalid' THEN 2 ELSE 3 END AS exit_code,
       expected_pairs, scheduled_pairs, completed_pairs, failed_pairs, expected_members, scheduled_members, completed_members, running_members, failed_members,
       greatest(expected_members - completed_members - running_members - failed_members, 0) AS pending_members,
       CASE WHEN expected_members > 0 THEN round(completed_members / expected_members * 100, 6) ELSE 0.0 END AS progress_percent,
       current_pair, round(greatest((epoch_us(finished) - epoch_us(created_at)) / 1000000.0, 0.0), 6) AS elapsed_seconds
FROM (SELECT st.*, CASE WHEN block % 5 <> 0 THEN block % 4 ELSE 0 END AS expected_pairs, CASE WHEN block % 5 <> 0 THEN block % 4 * 2 ELSE 0 END AS expected_members,
             CASE block % 6 WHEN 0 THEN 'complete' WHEN 1 THEN 'invalid' WHEN 2 THEN 'running' WHEN 3 THEN 'orphaned' WHEN 4 THEN 'unknown' ELSE 'invalid' END AS result,
             CASE block % 6 WHEN 0 THEN 'complete' WHEN 1 THEN 'invalid' WHEN 2 THEN 'running' WHEN 3 THEN 'running' WHEN 4 THEN 'paused' ELSE 'failed' END AS state_status,
             CASE WHEN block % 6 <> 4 THEN last_end ELSE TIMESTAMP '2030-01-01 00:00:00' END AS finished
      FROM (SELECT trial_id AS comparison_id, CAST(substr(trial_id, 7) AS BIGINT) AS block, min(started_at) AS created_at, max(finished_at) AS last_end
            FROM run_metrics GROUP BY ALL) st) s
JOIN (SELECT trial_id, count(*) AS scheduled_pairs, CAST(sum(attempt) AS BIGINT) AS completed_pairs, CAST(sum(1 - attempt) AS BIGINT) AS failed_pairs,
             arg_max(pair_id, position) AS current_pair
      FROM (SELECT trial_id, dag_run_id AS pair_id, retry_count AS attempt, max(sequence_position) AS position FROM run_metrics GROUP BY ALL)
      GROUP BY trial_id) a ON a.trial_id = s.comparison_id
JOIN (SELECT trial_id, count(status) AS scheduled_members, count(*) FILTER (status = 'complete') AS completed_members,
             count(*) FILTER (status = 'running') AS running_members, count(*) FILTER (status = 'failed') AS failed_members
      FROM (SELECT trial_id, CASE WHEN min(status) = 'FINISHED' THEN 'running' WHEN min(status) = 'success' THEN 'complete'
                                  WHEN max(sequence_position) % 2 = 0 THEN 'failed' END AS status
            FROM run_metrics GROUP BY trial_id, dag_run_id, retry_count, benchmark_run_id)
      GROUP BY trial_id) m ON m.trial_id = s.comparison_id"""))(_run_status)
