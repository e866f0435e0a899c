"""Registered queries: request evidence, cost, resources, application matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollgate.operators import evidence
from tollgate.plans import oracle
from tollgate.plans.registry import register, rnd
from tollgate.plans.registry_metrics import ATTEMPTS_SQL, _rm, members_of
from tollgate.sources.adapters import (EVENT_REQUEST_METRIC, price_offers, request_points,
                                       request_windows, resource_samples, stage_rows)

_METRIC_CASE = "CASE " + " ".join(f"WHEN event_type = '{t}' THEN '{m}'" for t, m in EVENT_REQUEST_METRIC.items()) + " END"

EVIDENCE_SQL = f"""
points AS (SELECT 'bucket-' || CAST(user_id % 4 AS VARCHAR) AS target, {_METRIC_CASE} AS metric, ts,
                  CASE WHEN event_type = 'error' THEN value * 1048576 ELSE value END AS value FROM events),
windows AS (SELECT measurement_protocol || ':' || CAST(CAST(started_at AS DATE) AS VARCHAR) AS block,
                   min(started_at) AS "start", max(finished_at) AS "end" FROM run_metrics GROUP BY 1),
matched AS (SELECT w.block, p.target, p.metric, p.ts, p.value FROM points p JOIN windows w
            ON p.ts >= w."start" - INTERVAL 60 SECOND AND p.ts <= w."end" + INTERVAL 120 SECOND)"""


def _matched(spark, sf):
    return evidence.points_in_windows(request_points(spark, sf), request_windows(_rm(spark, sf)))


register("request_windows", oracle.with_metrics("SELECT * FROM matched", EVIDENCE_SQL))(_matched)

register("evidence_complete", oracle.with_metrics(
    "SELECT w.block, coalesce(n, 0) AS datapoints, coalesce(n, 0) > 0 AS complete FROM windows w "
    "LEFT JOIN (SELECT block, count(*) AS n FROM matched GROUP BY block) m ON w.block = m.block", EVIDENCE_SQL))(
    lambda spark, sf: evidence.window_completeness(request_windows(_rm(spark, sf)), _window_totals(spark, sf)))


def _window_totals(spark, sf):
    points = request_points(spark, sf).withColumn("value", F.col("value").cast("decimal(38,6)"))
    return evidence.totals_in_windows(points, request_windows(_rm(spark, sf)))


register("window_totals", oracle.with_metrics(
    "SELECT block, metric, sum(coalesce(CAST(value AS DECIMAL(38,6)), 0)) AS total, count(*) AS datapoints "
    "FROM matched GROUP BY block, metric", EVIDENCE_SQL))(_window_totals)


def _totals(spark, sf):
    return evidence.request_totals(_window_totals(spark, sf))


register("request_totals", oracle.with_metrics(
    "SELECT metric, sum(coalesce(CAST(value AS DECIMAL(38,6)), 0)) AS total FROM matched GROUP BY metric",
    EVIDENCE_SQL))(_totals)


def _rates(spark, sf):
    offers = price_offers(spark, sf)
    # U4: the request price list and the transfer price list, concatenated.
    combined = offers.where(~F.col("is_transfer")).unionByName(offers.where(F.col("is_transfer")))
    return evidence.price_rates(combined)


RATES_SQL = """
offers AS (
  SELECT p_partkey,
         CASE WHEN p_size % 4 = 0 THEN 'put_requests' WHEN p_size % 4 = 1 THEN 'get_requests'
              WHEN p_size % 4 = 2 AND (p_size // 4) % 2 = 0 THEN 'bytes_downloaded' END AS rate_name,
         p_retailprice / 1e9 AS usd,
         CASE p_size % 4 WHEN 2 THEN 'GB' ELSE 'Requests' END AS unit,
         CASE p_size % 4 WHEN 0 THEN 'usd per put, copy, post, or list requests'
                         WHEN 1 THEN 'usd per get and all other requests'
                         ELSE 'usd per gb - data transfer out to the internet' END AS description,
         '0' AS begin_range, 'Inf' AS end_range
  FROM part),
rates AS (
  SELECT rate_name, arg_max(usd, p_partkey) AS usd, arg_max(unit, p_partkey) AS unit,
         arg_max(description, p_partkey) AS description, arg_max(begin_range, p_partkey) AS begin_range,
         arg_max(end_range, p_partkey) AS end_range
  FROM offers WHERE rate_name IS NOT NULL GROUP BY rate_name)"""

register("price_rates", oracle.with_ctes(RATES_SQL, body="SELECT * FROM rates"))(_rates)

register("cost_estimate", oracle.with_metrics("""
SELECT u.metric, u.rate_name, u.quantity, u.billable AS billable_quantity, r.usd, r.unit,
       u.billable * r.usd AS estimated_usd, r.usd IS NULL AS missing_rate
FROM (SELECT metric, quantity,
             CASE metric WHEN 'GetRequests' THEN 'get_requests' WHEN 'PutRequests' THEN 'put_requests'
                         ELSE 'bytes_downloaded' END AS rate_name,
             CASE WHEN metric = 'BytesDownloaded' THEN quantity / 1073741824.0 ELSE quantity END AS billable
      FROM (SELECT metric, CAST(sum(coalesce(CAST(value AS DECIMAL(38,6)), 0)) AS DOUBLE) AS quantity
            FROM matched GROUP BY metric)) u
LEFT JOIN rates r ON u.rate_name = r.rate_name""", EVIDENCE_SQL, RATES_SQL))(
    lambda spark, sf: evidence.cost_estimate(_totals(spark, sf).withColumnRenamed("total", "quantity"), _rates(spark, sf)))


def _resources(spark, sf):
    rm = _rm(spark, sf)
    members = members_of(rm)
    user = F.regexp_extract("benchmark_run_id", r"run-([0-9]+)-", 1).cast("bigint")
    capacity = members.select("benchmark_run_id", ((user % 3 + 1) * 4).cast("double").alias("cpu_cores")) \
        .dropDuplicates(["benchmark_run_id"]).withColumn("memory_gib", F.col("cpu_cores") * 1.5)
    out = evidence.resource_summary(resource_samples(spark, sf), members, capacity)
    return rnd(out, {c: 6 for c in ("cpu_seconds", "memory_gib_hours", "configured_cpu_hours",
                                     "configured_memory_gib_hours")})


register("resource_proxies", oracle.with_metrics("""
SELECT coalesce(u.architecture, c.architecture) AS architecture, round(cpu_seconds, 6) AS cpu_seconds,
       round(memory_gib_hours, 6) AS memory_gib_hours, round(configured_cpu_hours, 6) AS configured_cpu_hours,
       round(configured_memory_gib_hours, 6) AS configured_memory_gib_hours
FROM (SELECT m.architecture, sum(s.cpu / 100.0 * 5.0) AS cpu_seconds,
             sum(s.mem / 1073741824.0 * 5.0 / 3600) AS memory_gib_hours
      FROM samples s JOIN (SELECT DISTINCT benchmark_run_id, architecture FROM members) m
        ON s.benchmark_run_id = m.benchmark_run_id GROUP BY m.architecture) u
FULL OUTER JOIN (
      SELECT architecture, sum(cores * h) AS configured_cpu_hours, sum(cores * 1.5 * h) AS configured_memory_gib_hours
      FROM (SELECT DISTINCT benchmark_run_id, architecture,
                   CAST((CAST(regexp_extract(benchmark_run_id, 'run-([0-9]+)-', 1) AS BIGINT) % 3 + 1) * 4 AS DOUBLE) AS cores,
                   (epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0 / 3600 AS h
            FROM members) GROUP BY architecture) c
  ON u.architecture = c.architecture""", ATTEMPTS_SQL, """
samples AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) || '-' || CASE WHEN event_id % 2 = 0 THEN 'onprem' ELSE 'hybrid_aws' END
           AS benchmark_run_id,
         value / 5 AS cpu,
         CASE WHEN k % 3 = 0 THEN k * 1048576.0 WHEN k % 3 = 1 THEN (k / 10.0) * 1073741824.0 ELSE k * 1024 * 1.0 END AS mem
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""))(_resources)


def _j6(spark, sf):
    rm = _rm(spark, sf)
    name = F.concat(F.lit("trip-app-"), F.col("dataset"))
    tasks = rm.where(F.col("metric_type") == "airflow_task").select(
        F.col("metric_id").alias("task_key"), name.alias("name"), "started_at", "finished_at")
    apps = rm.where(F.col("metric_type") == "pipeline").select(
        F.col("metric_id").alias("app_id"), name.alias("name"), F.col("started_at").alias("start"),
        F.col("finished_at").alias("end"))
    return evidence.match_applications(tasks, apps)


register("app_match_overlap", oracle.with_metrics("""
SELECT t.task_key, t.name, b.app_id, b.app_id IS NOT NULL AS matched
FROM tasks t LEFT JOIN (
  SELECT task_key, app_id FROM (
    SELECT t.task_key, a.app_id,
           row_number() OVER (PARTITION BY t.task_key ORDER BY a.start DESC, a.app_id DESC) AS rn
    FROM tasks t JOIN apps a ON t.name = a.name AND a."end" >= t.started_at AND a.start <= t.finished_at)
  WHERE rn = 1) b ON t.task_key = b.task_key""", """
tasks AS (SELECT metric_id AS task_key, 'trip-app-' || dataset AS name, started_at, finished_at
          FROM run_metrics WHERE metric_type = 'airflow_task'),
apps AS (SELECT metric_id AS app_id, 'trip-app-' || dataset AS name, started_at AS start, finished_at AS "end"
         FROM run_metrics WHERE metric_type = 'pipeline')"""))(_j6)

_FIELDS = ["inputRecords", "outputRecords", "inputBytes", "outputBytes", "executorRunTime",
           "memoryBytesSpilled", "diskBytesSpilled", "shuffleReadBytes", "shuffleReadRecords",
           "shuffleWriteBytes", "shuffleWriteRecords"]
_SRC = {src: dst for dst, src in evidence.STAGE_COUNTERS.items()}

register("event_log_counters", oracle.with_ctes(f"""
stages AS (
  SELECT 'app-' || CAST(user_id AS VARCHAR) AS app_id,
         CASE WHEN value < 1.0 THEN 'FAILED' ELSE 'COMPLETE' END AS status,
         {', '.join(f'CASE WHEN k % {i + 2} <> 0 THEN k * {i + 1} END AS {f}' for i, f in enumerate(_FIELDS))}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))""", body=f"""
SELECT app_id, {', '.join(f'CAST(sum(coalesce({f}, 0)) AS BIGINT) AS {_SRC[f]}' for f in _FIELDS)}
FROM stages WHERE status = 'COMPLETE' GROUP BY app_id"""))(
    lambda spark, sf: evidence.app_counters(stage_rows(spark, sf)))
