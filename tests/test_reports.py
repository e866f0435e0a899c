"""Composite reports: cardinality, completeness, sizing, run status, cost total."""

import datetime as dt

from pyspark.sql import functions as F

from tollgate.operators import coverage, evidence, validation
from tollgate.plans import reports

T0 = dt.datetime(2024, 1, 1)


def rules(df):
    return sorted((r.subject, r.rule, r.observed) for r in df.collect())


def test_properties_last_pair_counts_and_missing_lists(spark):
    tasks = spark.createDataFrame([
        ("ok", "r", [["spark.cores.max", "1"], ["spark.cores.max", "4"]]), ("other", "r", [["spark.cores.max", "8"]]),
        ("short", "r", [["spark.cores.max"]]), ("empty", "r", []), ("none", "r", None), ("unscheduled", "x", [])],
        "metric_id string, benchmark_run_id string, spark_properties array<array<string>>")
    scheduled = spark.createDataFrame([("r", "spark.cores.max", "4")], "benchmark_run_id string, key string, value string")
    got = {r.metric_id: r.recorded_value for r in validation.property_mismatches(tasks, scheduled).collect()}
    assert got == {"other": "8", "short": None, "empty": None, "none": None}


def test_cost_total_counts_absent_usage_as_zero_and_names_missing_rates(spark):
    rates = spark.createDataFrame([("get_requests", 0.5, "Requests"), ("put_requests", 2.0, "per 1k requests")], "rate_name string, usd double, unit string")
    usage = spark.createDataFrame([("PutRequests", 3000.0), ("Other", 9.0)], "metric string, quantity double")
    cost = evidence.cost_estimate(usage, rates)
    assert {r.metric: (r.quantity, r.estimated_usd) for r in cost.collect()} == {
        "PutRequests": (3000.0, 6.0), "GetRequests": (0.0, 0.0), "BytesDownloaded": (0.0, None)}
    assert tuple(evidence.cost_total(cost).first()) == (6.0, ["bytes_downloaded"])
    assert tuple(evidence.cost_total(cost.where("false")).first()) == (0.0, [])


def test_run_status_classifies_many_runs(spark):
    end = T0 + dt.timedelta(seconds=90)
    states = spark.createDataFrame([
        ("a", "complete", False, T0, end), ("b", "running", True, T0, None), ("c", "running", None, T0, None),
        ("d", "failed", True, None, end), ("e", None, False, end, T0), ("f", "dry_run_complete", False, T0, T0)],
        "comparison_id string, status string, runner_active boolean, created_at timestamp, finished_at timestamp")
    members = spark.createDataFrame([
        ("b", "p1", 1, 1, "failed", "failed"), ("b", "p1", 2, 2, "complete", "complete"), ("b", "p1", 2, 2, "complete", "complete"),
        ("b", "p2", 1, 3, "running", "running"), ("c", "p9", 1, 1, "running", None)],
        "comparison_id string, pair_id string, attempt int, position int, attempt_status string, member_status string")
    expected = spark.createDataFrame([("a", 0, 0), ("b", 4, 8)], "comparison_id string, expected_pairs long, expected_members long")
    out = {r.comparison_id: r for r in coverage.run_status(states, members, expected, now=F.lit(T0 + dt.timedelta(seconds=10))).collect()}
    assert {k: (r.result, r.exit_code, r.elapsed_seconds) for k, r in out.items()} == {
        "a": ("complete", 0, 90.0), "b": ("running", 1, 10.0), "c": ("orphaned", 3, 10.0),
        "d": ("invalid", 2, None), "e": ("unknown", 3, 0.0), "f": ("complete", 0, 0.0)}
    b, c = out["b"], out["c"]
    assert (b.scheduled_pairs, b.completed_pairs, b.failed_pairs, b.scheduled_members, b.completed_members, b.running_members,
            b.failed_members, b.pending_members, b.progress_percent, b.current_pair) == (3, 1, 1, 4, 2, 1, 1, 4, 25.0, "p2")
    assert (c.scheduled_pairs, c.scheduled_members, c.progress_percent, c.current_pair) == (1, 0, 0.0, "p9")


MEMBER = "pair_id string, architecture string, layout string, benchmark_run_id string, sequence_position int, status string"
CELLS = [("onprem", "fragmented"), ("onprem", "compact"), ("hybrid_aws", "fragmented"), ("hybrid_aws", "compact")]


def cells_of(pair, first):
    return [(pair, a, lay, f"{pair}{i}", first + i, "complete") for i, (a, lay) in enumerate(CELLS)]


def test_layout_members_whole_design_has_no_violations(spark):
    rows = cells_of("p", 1) + cells_of("q", 5)
    metrics = spark.createDataFrame([(r[3], "trino_query") for r in rows], "benchmark_run_id string, metric_type string")
    pairs = spark.createDataFrame([("p",), ("q",)], "pair_id string")
    assert rules(reports.layout_member_violations(metrics, spark.createDataFrame(rows, MEMBER), pairs)) == []
    broken = rows[:3] + [("q", "onprem", "compact", "p0", 9, None)] + rows[4:]
    got = rules(reports.layout_member_violations(metrics, spark.createDataFrame(broken, MEMBER), spark.createDataFrame([("p",), ("z",)], "pair_id string")))
    assert got == [("members", "sequence_positions", "8"), ("p", "pair_cells", "3/3"), ("p0", "duplicate_run_id", "2"), ("p0", "member_incomplete", ""),
                   ("q", "pair_cells", "5/4"), ("q", "pair_unexpected", ""), ("z", "pair_missing", "")]


def test_layout_report_counts_pairs_without_a_measure_as_missing(spark):
    rows = []
    for pair, values in (("p", (4.0, 2.0, 9.0, 3.0)), ("q", (None,) * 4)):
        rows += [("cmp", pair, "warm_recorded", "trino_query", "q1", a, lay, f"{pair}{i}", f"m{pair}{i}", T0, v, i + 1 + 4 * (pair == "q"))
                 for i, ((a, lay), v) in enumerate(zip(CELLS, values))]
    metrics = spark.createDataFrame(rows, "comparison_id string, trial_id string, measurement_protocol string, metric_type string, query_name string, "
                                    "architecture string, file_layout string, benchmark_run_id string, metric_id string, started_at timestamp, "
                                    "duration_seconds double, sequence_position int")
    members = metrics.select(F.col("trial_id").alias("pair_id"), "architecture", F.col("file_layout").alias("layout"), "benchmark_run_id",
                             "sequence_position", F.lit("complete").alias("status"))
    out = reports.layout_effect_report(metrics, measures=["duration_seconds"], resamples=10, members=members)
    effects = out["effects"].collect()
    assert {(r.complete_pairs, r.missing_pairs) for r in effects} == {(1, 1)}
    assert {r.effect: r.median for r in effects}["fragmentation_interaction_percentage_points"] == 100.0
    assert out["verdict"].first().status == validation.READY


def test_sizing_report_by_rule(spark):
    schedule = spark.createDataFrame([("p", "small", "w", 4, 2, 1), ("p", "medium", "w", 8, 2, 2), ("p", "default", "w", 16, 4, 3)],
                                     "pair_id string, profile string, workload_name string, cores_max int, executor_cores int, sequence_position int")
    members = spark.createDataFrame([("p", "small", 4, 2, 1, "r1", "complete"), ("p", "medium", 8, 4, 2, "r2", "failed"), ("x", "small", 4, 2, 9, "r3", "complete")],
                                    "pair_id string, profile string, cores_max int, executor_cores int, sequence_position int, benchmark_run_id string, status string")
    good = [["spark.cores.max", "4"], ["spark.executor.cores", "2"]]
    metrics = [("r1", f"t{i}", "airflow_task", "success", 1.0, good) for i in range(3)] + [("r1", "p1", "pipeline", "success", 5.0, None),
               ("r2", "t9", "airflow_task", "success", 1.0, [["spark.cores.max", "8"]]), ("r2", "p2", "pipeline", "failed", 7.0, None)]
    metrics = spark.createDataFrame(metrics, "benchmark_run_id string, metric_id string, metric_type string, status string, duration_seconds double, "
                                    "spark_properties array<array<string>>")
    artifacts = metrics.select("metric_id").where("metric_id <> 'p2'").unionAll(spark.createDataFrame([("gone",)], "metric_id string"))
    out = reports.executor_sizing_report(schedule, members, metrics, artifacts)
    assert rules(out["violations"]) == sorted([
        ("p/default", "member_missing", ""), ("x/small", "member_unexpected", ""), ("p/medium", "schedule_executor_cores", "4"),
        ("p/medium", "member_incomplete", "failed"), ("r2", "task_metrics", "1"), ("r3", "task_metrics", "0"), ("r2", "pipeline_metric", "0/1"),
        ("r3", "pipeline_metric", "0/0"), ("t9", "not_applied:spark.executor.cores", ""), ("gone", "metric_id_only_artifact", ""), ("p2", "metric_id_only_table", "")])
    assert [tuple(r) for r in out["medians"].collect()] == [("w", "small", 1, 5.0, 5.0, 5.0)]
    assert out["verdict"].first().status == validation.INVALID


def test_comparison_rules(spark):
    attempts = spark.createDataFrame([
        ("p", 1, "a", "onprem", "pipeline_paired", "failed"), ("p", 2, "a", "onprem", "pipeline_paired", "complete"),
        ("p", 2, "b", "hybrid_aws", "pipeline_paired", "complete"), ("w", 1, "c", "onprem", "warmup", "complete"), ("n", 1, "d", "onprem", "cold", "failed")],
        "pair_id string, attempt int, benchmark_run_id string, architecture string, protocol string, attempt_status string")
    cols = ("benchmark_run_id string, metric_id string, metric_type string, query_id string, status string, task_id string, spark_application_id string, "
            "duration_seconds double, architecture string, table_name string, dataset string, year int, month int, records_read long, file_count long")
    row = lambda run, mid, kind, qid=None, status="FINISHED", files=None: (
        run, mid, kind, qid, status, None, None, 1.0, "x", "t", "yellow", 2011, 1, 5, files)
    metrics = spark.createDataFrame([
        row("a", "m1", "trino_query", "q1"), row("a", "m2", "trino_query", "q1"), row("a", "m3", "trino_query", ""),
        row("a", "m4", "iceberg_partition", files=1), row("a", "m5", "iceberg_partition", files=2), row("c", "m6", "trino_query", "q9", "FAILED"),
        row("d", "m6", "pipeline", status="failed")], cols)
    expected = spark.createDataFrame([("p",), ("n",), ("w",), ("z",)], "pair_id string")
    artifacts = spark.createDataFrame([("a", f"m{i}") for i in (1, 2, 3, 4, 7)] + [("c", "other")], "benchmark_run_id string, metric_id string")
    results = spark.createDataFrame([("k1", "onprem", 1), ("k1", "hybrid_aws", 1), ("k2", "onprem", 1), ("k2", "hybrid_aws", None), ("k3", "onprem", 2)],
                                    "run_key string, architecture string, result long")
    got = rules(reports.comparison_violations(metrics, attempts, expected, artifacts, results))
    assert got == sorted([
        ("n", "complete_attempts", "expected one complete attempt, found 0"), ("n", "pair_missing", ""), ("z", "pair_missing", ""),
        ("m6", "duplicate_metric_id", "2"), ("q1", "duplicate_query_id", "2"), ("b", "metrics_missing", ""), ("m3", "query_id_required", ""),
        ("onprem/t/yellow/2011/1", "repeated_write_changed", "2"), ("a", "artifact_ids_differ", "2"),
        ("k2", "results_differ", "2/2"), ("k3", "results_differ", "1/1")])


def test_comparison_reads_the_attempts_once(spark):
    metrics = spark.createDataFrame([("a", "m1", "pipeline", None, "success", None, None, 1.0, "onprem", "t", "yellow", 2011, 1, 5, 1)], (
        "benchmark_run_id string, metric_id string, metric_type string, query_id string, status string, task_id string, spark_application_id string, "
        "duration_seconds double, architecture string, table_name string, dataset string, year int, month int, records_read long, file_count long"))
    attempts = spark.range(2).select(
        F.concat(F.lit("made-once-"), F.col("id").cast("string")).alias("pair_id"), F.lit(1).alias("attempt"), F.lit("a").alias("benchmark_run_id"),
        F.lit("onprem").alias("architecture"), F.lit("cold").alias("protocol"), F.lit("complete").alias("attempt_status"))
    found = reports.comparison_violations(metrics, attempts)
    assert "made-once-" not in found._jdf.queryExecution().analyzed().toString()
    assert rules(found) == []
