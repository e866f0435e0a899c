import datetime as dt
import json

from pyspark.sql import functions as F

from tollgate.operators import coverage, evidence, pairing, validation
from tollgate.operators.metric_rows import pipeline_rows, query_rows, task_rows, union_metrics
from tollgate.schemas import RUN_METRICS

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_select_partitions(spark):
    parts = spark.createDataFrame([("yellow", 2011, 1), ("yellow", 2011, 4), ("green", 2014, 1)],
                                  "dataset string, year int, month int")
    assert coverage.select_partitions(parts, "yellow", 2011, 1).count() == 1
    assert coverage.select_partitions(parts, dataset="yellow").count() == 2
    assert coverage.select_partitions(parts, year=2099).isEmpty()


def test_accepted_members(spark):
    am = spark.createDataFrame([
        ("p1", 1, "failed", "r1a", "onprem"), ("p1", 2, "complete", "r1b", "onprem"),
        ("p1", 2, "complete", "r1c", "hybrid_aws"),
        ("p2", 1, "complete", "r2a", "onprem"), ("p2", 2, "complete", "r2b", "onprem"),
        ("p3", 1, "failed", "r3a", "onprem"),
    ], "pair_id string, attempt int, attempt_status string, benchmark_run_id string, architecture string")
    members, violations = pairing.accepted_members(am)
    assert sorted((r.benchmark_run_id, r.retry_count) for r in members.collect()) == [("r1b", 1), ("r1c", 1)]
    assert sorted(r.pair_id for r in violations.collect()) == ["p2", "p3"]


def test_pairing_keeps_complete_pairs_and_latest(spark):
    members = spark.createDataFrame([("a1", "p1", "warm", "onprem"), ("b1", "p1", "warm", "hybrid_aws"),
                                     ("a2", "p2", "warm", "onprem")],
                                    "benchmark_run_id string, pair_id string, protocol string, architecture string")
    rows = [("a1", "m1", "trino_query", "q", "yellow", 2011, 1, 1.0, T0),
            ("a1", "m2", "trino_query", "q", "yellow", 2011, 1, 2.0, T0 + dt.timedelta(1)),
            ("b1", "m3", "trino_query", "q", "yellow", 2011, 1, 4.0, T0),
            ("a2", "m4", "trino_query", "q", "yellow", 2011, 1, 9.0, T0)]
    metrics = spark.createDataFrame(rows, "benchmark_run_id string, metric_id string, metric_type string, "
                                          "query_name string, dataset string, year int, month int, "
                                          "duration_seconds double, started_at timestamp")
    pairs = pairing.pair_by_architecture(pairing.scoped_metrics(metrics, members)).collect()
    assert [(r.key, r.pair_id, r.onprem, r.hybrid_aws) for r in pairs] == [("warm:query:q:yellow:2011:1", "p1", 2.0, 4.0)]


def test_layout_effects_cells(spark):
    rows = []
    for arch, lay, v in (("onprem", "fragmented", 12.0), ("onprem", "compact", 10.0),
                         ("hybrid_aws", "fragmented", 30.0), ("hybrid_aws", "compact", 20.0)):
        rows.append(("warm", "q", "t1", arch, lay, v, T0, f"{arch}{lay}"))
    rows.append(("warm", "q", "t2", "onprem", "compact", 1.0, T0, "x"))
    df = spark.createDataFrame(rows, "measurement_protocol string, query_name string, trial_id string, "
                                     "architecture string, file_layout string, duration_seconds double, "
                                     "started_at timestamp, metric_id string")
    cells = pairing.assemble_cells(df, "duration_seconds", pair_col="trial_id")
    eff = {r.effect: r.value for r in pairing.layout_effect_rows(cells, pair_col="trial_id").collect()}
    assert eff["onprem_fragmentation_penalty_percent"] == 20.0
    assert eff["hybrid_fragmentation_penalty_percent"] == 50.0
    assert eff["fragmentation_interaction_percentage_points"] == 30.0
    counts = pairing.layout_effects(cells, pair_col="trial_id", resamples=20).first()
    assert (counts.complete_pairs, counts.missing_pairs) == (1, 1)


def test_validation_rules(spark):
    m = spark.createDataFrame([
        ("m1", "trino_query", None, "FINISHED", None, None, 1.0),
        ("m2", "trino_query", "q2", "FAILED", None, None, 1.0),
        ("m3", "pipeline", None, "success", None, None, -1.0),
        ("m4", "airflow_task", None, "success", "stage_trips", None, 1.0),
    ], "metric_id string, metric_type string, query_id string, status string, task_id string, "
       "spark_application_id string, duration_seconds double")
    got = sorted((r.subject, r.rule) for r in validation.rule_violations(m).collect())
    assert got == [("m1", "query_id_required"), ("m2", "query_finished"), ("m3", "positive_duration"),
                   ("m4", "spark_application_id_required")]
    v = validation.verdict([validation.rule_violations(m)]).first()
    assert v.status == validation.BLOCKED and v.violations == 4
    ok = validation.verdict([validation.rule_violations(m.where("false"))], accepted_on="2026-01-01").first()
    assert ok.status == "ACCEPTED 2026-01-01"


def test_write_consistency_and_sequence(spark):
    m = spark.createDataFrame([
        ("onprem", "iceberg_partition", "t", "yellow", 2011, 1, 10, 2),
        ("onprem", "iceberg_partition", "t", "yellow", 2011, 1, 10, 3),
        ("onprem", "iceberg_partition", "t", "yellow", 2011, 4, 10, 2),
        ("onprem", "iceberg_partition", "t", "yellow", 2011, 4, 10, 2),
    ], "architecture string, metric_type string, table_name string, dataset string, year int, month int, "
       "records_read bigint, file_count bigint")
    assert [r.month for r in validation.write_inconsistencies(m).collect()] == [1]
    seq = spark.createDataFrame([(1,), (2,), (2,), (4,)], "sequence_position int")
    assert validation.sequence_gaps(seq).first().contiguous is False


def test_cardinality_with_missing_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    groups = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    got = sorted((r.g, r.observed) for r in validation.cardinality_violations(df, ["g"], 2, groups).collect())
    assert got == [("b", 1), ("c", 0)]


def test_coverage_grid_counts(spark):
    targets = spark.createDataFrame([("q", "yellow", 2011, 1), ("q", "green", 2014, 1)],
                                    "query_name string, dataset string, year int, month int")
    grid = coverage.coverage_grid(targets, {"warmup": 1, "warm_recorded": 5, "service_cold_recorded": 3}, 3,
                                  [("onprem", "fragmented"), ("onprem", "compact"),
                                   ("hybrid_aws", "fragmented"), ("hybrid_aws", "compact")])
    c = coverage.expected_counts(grid, ["query_name", "dataset", "year", "month"]).first()
    assert (c.expected_pairs, c.expected_members) == (2 * 3 * 9, 2 * 3 * 9 * 4)


def test_results_equivalent_tolerance(spark):
    a = spark.createDataFrame([("k1", 1.0, "x"), ("k2", 2.0, "y"), ("k3", 3.0, "z")], "k string, v double, s string")
    b = spark.createDataFrame([("k1", 1.0 + 1e-12, "x"), ("k2", 2.1, "y"), ("k4", 4.0, "w")], "k string, v double, s string")
    got = sorted((r.k, r.mismatch, r.column) for r in coverage.results_equivalent(a, b, ["k"]).collect())
    assert got == [("k2", "value", "v"), ("k3", "missing_right", None), ("k4", "missing_left", None)]
    assert coverage.rows_equivalent(a, a)


def test_reconcile_and_gaps(spark):
    a = spark.createDataFrame([("m1",), ("m2",)], "metric_id string")
    b = spark.createDataFrame([("m2",), ("m3",)], "metric_id string")
    assert sorted((r.metric_id, r.side) for r in coverage.reconcile_ids(a, b, "metric_id").collect()) == \
        [("m1", "only_artifact"), ("m3", "only_table")]
    assert sorted((r.metric_id, r.gap) for r in coverage.coverage_gaps(a, b, ["metric_id"]).collect()) == \
        [("m1", "missing"), ("m3", "unexpected")]


def offer(group, gdesc, usd, unit="Requests", desc="USD per request", service="AmazonS3", family="API Request",
          begin="0", extra=None):
    attrs = {"group": group, "groupDescription": gdesc, **(extra or {})}
    return json.dumps({"serviceCode": service, "product": {"productFamily": family, "attributes": attrs},
                       "terms": {"OnDemand": {"t": {"priceDimensions": {"d": {
                           "description": desc, "unit": unit, "beginRange": begin, "endRange": "Inf",
                           "pricePerUnit": {"USD": usd}}}}}}})


def test_cost_units(spark):
    offers = spark.createDataFrame([
        (1, offer("S3-API-Tier1", "PUT/COPY/POST or LIST requests", "0.000005")),
        (2, offer("S3-API-Tier2", "GET and all other requests", "0.0000004")),
    ], "offer_id int, offer string")
    rates = evidence.price_rates(offers)
    usage = spark.createDataFrame([("PutRequests", 2.0), ("GetRequests", 10.0), ("BytesDownloaded", 5.0)],
                                  "metric string, quantity double")
    cost = {r.metric: r for r in evidence.cost_estimate(usage, rates).collect()}
    total = sum(r.estimated_usd for r in cost.values() if not r.missing_rate)
    assert abs(total - 0.000014) < 1e-15
    assert cost["BytesDownloaded"].missing_rate is True


def test_transfer_rate_first_tier_only(spark):
    t = {"fromRegionCode": "us-east-1", "transferType": "AWS Outbound", "toLocation": "External"}
    offers = spark.createDataFrame([
        (1, offer("", "", "0.09", unit="GB", desc="data transfer out", service="AWSDataTransfer",
                  family="Data Transfer", extra=t)),
        (2, offer("", "", "0.05", unit="GB", desc="data transfer out", service="AWSDataTransfer",
                  family="Data Transfer", begin="10240", extra=t)),
    ], "offer_id int, offer string")
    rates = {r.rate_name: r.usd for r in evidence.price_rates(offers).collect()}
    assert rates == {"bytes_downloaded": 0.09}


def test_missing_datapoints_incomplete_window(spark):
    windows = spark.createDataFrame([("pipeline", T0, T0 + dt.timedelta(minutes=5)),
                                     ("cold", T0 + dt.timedelta(hours=5), T0 + dt.timedelta(hours=6))],
                                    "block string, start timestamp, end timestamp")
    points = spark.createDataFrame([("b", "GetRequests", T0 - dt.timedelta(seconds=30), 3.0),
                                    ("b", "GetRequests", T0 + dt.timedelta(minutes=6, seconds=30), 4.0),
                                    ("b", "GetRequests", T0 + dt.timedelta(minutes=9), 5.0)],
                                   "target string, metric string, ts timestamp, value double")
    matched = evidence.points_in_windows(points, windows)
    assert sorted(r.value for r in matched.collect()) == [3.0, 4.0]
    comp = {r.block: r.complete for r in evidence.window_completeness(windows, matched).collect()}
    assert comp == {"pipeline": True, "cold": False}
    assert evidence.request_totals(matched).first().total == 7.0


def test_match_applications_latest_overlap_and_open_bounds(spark):
    tasks = spark.createDataFrame([("t1", "app", T0, T0 + dt.timedelta(minutes=10)),
                                   ("t2", "app", T0 + dt.timedelta(days=2), T0 + dt.timedelta(days=2, minutes=1)),
                                   ("t3", "other", T0, None)],
                                  "task_key string, name string, started_at timestamp, finished_at timestamp")
    apps = spark.createDataFrame([("a1", "app", T0 - dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=1)),
                                  ("a2", "app", T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=20)),
                                  ("a3", "other", T0 - dt.timedelta(days=1), None)],
                                 "app_id string, name string, start timestamp, end timestamp")
    got = {r.task_key: (r.app_id, r.matched) for r in evidence.match_applications(tasks, apps).collect()}
    assert got == {"t1": ("a2", True), "t2": (None, False), "t3": ("a3", True)}


def test_resource_summary(spark):
    samples = spark.createDataFrame([("r1", 50.0, "1GiB"), ("r1", 100.0, "512 MiB")],
                                    "benchmark_run_id string, cpu_percent double, memory string")
    members = spark.createDataFrame([("r1", "onprem", T0, T0 + dt.timedelta(hours=2))],
                                    "benchmark_run_id string, architecture string, started_at timestamp, finished_at timestamp")
    cap = spark.createDataFrame([("r1", 4.0, 6.0)], "benchmark_run_id string, cpu_cores double, memory_gib double")
    r = evidence.resource_summary(samples, members, cap).first()
    assert r.cpu_seconds == 0.5 * 5 + 1.0 * 5
    assert abs(r.memory_gib_hours - 1.5 * 5 / 3600) < 1e-12
    assert (r.configured_cpu_hours, r.configured_memory_gib_hours) == (8.0, 12.0)


def test_app_counters_complete_only(spark):
    stages = spark.createDataFrame([("a", "COMPLETE", 10, None), ("a", "FAILED", 99, 99), ("a", "COMPLETE", 5, 1)],
                                   "app_id string, status string, inputRecords bigint, outputRecords bigint")
    r = evidence.app_counters(stages.withColumns({c: F.lit(None) for c in (
        "inputBytes", "outputBytes", "executorRunTime", "memoryBytesSpilled", "diskBytesSpilled",
        "shuffleReadBytes", "shuffleReadRecords", "shuffleWriteBytes", "shuffleWriteRecords")})).first()
    assert (r.records_read, r.records_written, r.input_bytes) == (15, 1, 0)


def test_union_metrics_ids_and_fallback(spark):
    base = {"benchmark_run_id": "run1", "dag_run_id": "dag1", "dataset": "yellow", "year": 2011, "month": 4,
            "repetition": 1}
    dag = spark.createDataFrame([{**base, "state": "success", "start_date": "2024-01-01T00:00:00Z",
                                  "end_date": "2024-01-01T00:01:30Z"}])
    task = spark.createDataFrame([{**base, "task_id": "stage_trips", "state": "success", "spark_application_id": "app",
                                   "start_date": "2024-01-01T00:00:00Z", "end_date": "2024-01-01T00:00:10Z",
                                   "duration": None}], schema="benchmark_run_id string, dag_run_id string, dataset string, year int, month int, repetition int, task_id string, state string, spark_application_id string, start_date string, end_date string, duration double")
    q = spark.createDataFrame([{**base, "query_name": "q1", "query_id": "x", "query_repetition": 2, "state": "FINISHED",
                                "started_at": "2024-01-01T00:00:00Z", "finished_at": "2024-01-01T00:00:01Z",
                                "duration_seconds": 1.0, "processed_rows": 5, "row_count": 1,
                                "physical_input_bytes": 100}])
    out = union_metrics(pipeline_rows(dag), task_rows(task), query_rows(q))
    assert out.columns == [f.name for f in RUN_METRICS.fields]
    got = {r.metric_type: (r.metric_id, r.duration_seconds) for r in out.collect()}
    assert got["pipeline"] == ("dag1__pipeline", 90.0)
    assert got["airflow_task"] == ("dag1__task__stage_trips", 10.0)
    assert got["trino_query"] == ("run1__yellow_2011_04__query__q1__qr02", 1.0)


def test_reports_compose(spark, tmp_path):
    from tollgate.plans import reports
    from tollgate.plans.registry_metrics import attempt_members
    from tollgate.sources.adapters import run_metrics

    rm = run_metrics(spark, "/root/testdata/sf0.001")
    out = reports.paired_comparison_report(rm, attempt_members(rm), resamples=50)
    assert out["verdict"].first().status in ("ACCEPTANCE BLOCKED", "READY FOR MANUAL ACCEPTANCE")
    assert out["summary"].count() > 0
    eff = reports.layout_effect_report(rm, measures=["duration_seconds"], resamples=20)
    assert set(eff) == {"effects", "sequence", "violations", "verdict"}
    pr = reports.pruning_report(rm, "01_partition_financial_aggregation", "03_dataset_financial_scan")
    assert pr["findings"].count() == 1
    src = spark.range(64).select((F.col("id") % 2).cast("int").alias("month"), F.col("id"))
    pre = reports.layout_preflight(spark, src, str(tmp_path / "l"), ["month"], "fragmented", n_files=4)
    assert pre["content_mismatches"].isEmpty()
    assert pre["layout_gaps"].isEmpty()


def test_expand_targets_by_scope(spark):
    queries = spark.createDataFrame([("q_part", "partition"), ("q_scan", "dataset")], "query_name string, scope string")
    parts = spark.createDataFrame([("yellow", 2011, 1, 1), ("yellow", 2011, 4, 2), ("green", 2014, 1, 3)],
                                  "dataset string, year int, month int, position int")
    got = sorted(r.name for r in coverage.expand_targets(queries, parts).collect())
    assert got == ["q_part_green_2014_01", "q_part_yellow_2011_01", "q_part_yellow_2011_04",
                   "q_scan_green_2014_01", "q_scan_yellow_2011_01"]


def test_match_applications_long_running_app_behind_latest(spark):
    tasks = spark.createDataFrame([("t", "app", T0, T0 + dt.timedelta(minutes=5))],
                                  "task_key string, name string, started_at timestamp, finished_at timestamp")
    apps = spark.createDataFrame([("long", "app", T0 - dt.timedelta(hours=10), T0 + dt.timedelta(hours=10)),
                                  ("short", "app", T0 - dt.timedelta(hours=1), T0 - dt.timedelta(minutes=30))],
                                 "app_id string, name string, start timestamp, end timestamp")
    # the latest-started app ended before the task: the covering long app wins
    assert evidence.match_applications(tasks, apps).first().app_id == "long"


def test_latest_at_or_before_hot_key_and_ties(spark):
    from tollgate.operators.sequence import latest_at_or_before

    ev = spark.createDataFrame([("k", i, f"e{i:03d}") for i in range(0, 300, 3)] + [("k", 30, "e030b"), ("z", 5, "z5")],
                               "key string, t int, id string")
    pts = spark.createDataFrame([("k", 31), ("k", 30), ("k", 2), ("z", 4), ("z", 400), ("q", 1)], "key string, at int")
    got = {(r.key, r.at): (r._match.id if r._match else None)
           for r in latest_at_or_before(ev, pts, ["key"], "t", "at", "id", partitions=7).collect()}
    assert got == {("k", 31): "e030b", ("k", 30): "e030b", ("k", 2): "e000", ("z", 4): None,
                   ("z", 400): "z5", ("q", 1): None}
