"""Composite report jobs (C5-C9): compositions of the analytics operators.

Each returns named DataFrames (effects, violations, verdict, ...); nothing
is rendered to text and nothing is collected except the verdict row the
caller may ``first()``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import coverage, evidence, marts, pairing, stats, validation
from tollgate.session import checkpoint_root
from tollgate.sources import layout, tables


def layout_preflight(spark: SparkSession, source: DataFrame, target: str, part_cols: Sequence[str],
                     kind: str, n_files: int = 16) -> dict[str, DataFrame]:
    """Rewrite a layout, then verify it (S12 -> S13, A11-A13 -> J9/J10).

    The rewritten table must hold the same content (row count, NULL counts,
    checksum and deterministic aggregates) and the expected file layout.
    """
    layout.rewrite_layout(source, target, part_cols, kind, n_files=n_files)
    rewritten = tables.read_table(spark, target).select(*source.columns)
    inv = layout.file_inventory(spark, target, part_cols)
    rows = marts.row_count(source, by=list(part_cols))
    keys = list(part_cols)

    def cast_keys(df):
        return df.select(*[F.col(c).cast("string").alias(c) for c in keys], *[c for c in df.columns if c not in keys])

    content = coverage.results_equivalent(cast_keys(marts.content_profile(source, keys)),
                                          cast_keys(marts.content_profile(rewritten, keys)), keys)
    gaps = layout.layout_gaps(inv, rows, n_files if kind == "fragmented" else 1, keys)
    out = {"inventory": inv, "content_mismatches": content, "layout_gaps": gaps}
    if {"is_valid_trip", "pickup_location_id", "total_amount"} <= set(source.columns):
        # Trip tables also compare the deterministic query fingerprints.
        out["result_mismatches"] = coverage.results_equivalent(
            cast_keys(marts.deterministic_results(source, keys)),
            cast_keys(marts.deterministic_results(rewritten, keys)), keys)
    return out


def paired_comparison_report(metrics: DataFrame, attempt_members: DataFrame,
                             samples: DataFrame | None = None, capacity: DataFrame | None = None,
                             points: DataFrame | None = None, windows: DataFrame | None = None,
                             offers: DataFrame | None = None, accepted_on: str | None = None,
                             resamples: int = stats.BOOTSTRAP_RESAMPLES, expected_pairs: DataFrame | None = None,
                             artifact_ids: DataFrame | None = None, results: DataFrame | None = None) -> dict[str, DataFrame]:
    """Accepted members, paired summaries + bootstrap, resources, cost,
    completeness rules and the acceptance verdict.  The optional inputs are
    those of :func:`comparison_violations`."""
    members, _ = pairing.accepted_members(attempt_members)
    # Pairs feed the summary, the bootstrap and its size check: materialize
    # once (reliable checkpoint on the shared folder; one row per key x pair).
    checkpoint_root(metrics.sparkSession)
    pairs = pairing.pair_by_architecture(pairing.scoped_metrics(metrics, members)).checkpoint(eager=True)
    out = {
        "members": members,
        "summary": pairing.paired_summary(pairs),
        "intervals": pairing.paired_intervals(pairs, resamples=resamples),
    }
    if samples is not None:
        out["resources"] = evidence.resource_summary(samples, members, capacity)
    complete = None
    if points is not None and windows is not None:
        matched = evidence.totals_in_windows(points, windows)
        complete = evidence.window_completeness(windows, matched)
        out["request_totals"] = evidence.request_totals(matched)
        if offers is not None:
            usage = out["request_totals"].withColumnRenamed("total", "quantity")
            out["cost"] = evidence.cost_estimate(usage, evidence.price_rates(offers))
            out["cost_total"] = evidence.cost_total(out["cost"])
    out["violations"] = comparison_violations(metrics, attempt_members, expected_pairs, artifact_ids, results, samples, complete)
    out["verdict"] = validation.verdict([out["violations"]], accepted_on)
    return out


def comparison_violations(metrics: DataFrame, attempt_members: DataFrame, expected_pairs: DataFrame | None = None,
                          artifact_ids: DataFrame | None = None, results: DataFrame | None = None,
                          samples: DataFrame | None = None, windows: DataFrame | None = None) -> DataFrame:
    """C6 rules as (subject, rule, observed) rows; no rows = complete evidence.

    Pairs without one complete attempt; scheduled pairs (``expected_pairs``:
    pair_id) without an accepted one; metric and query ids that occur twice;
    accepted members without metrics or whose metric ids differ from those of
    their artifact (``artifact_ids``: benchmark_run_id, metric_id; warmups are
    exempt); required fields of accepted members' metrics; repeated writes of one
    partition that recorded other counts; keys whose ``results`` (run_key, architecture,
    result) differ between architectures or lack one; members without ``samples`` or with
    sampling errors (``is_error``, if there); ``windows`` (block, complete) without datapoints.
    """
    # Most rules start from the members: made once, on the shared folder, one row per attempt and member.
    checkpoint_root(metrics.sparkSession)
    attempt_members = attempt_members.checkpoint(eager=True)
    members, attempts = pairing.accepted_members(attempt_members)
    members = members.checkpoint(eager=True)
    runs = members.select("benchmark_run_id", "pair_id", "architecture", "protocol").dropDuplicates(["benchmark_run_id"])
    recorded = runs.where(~F.col("protocol").eqNullSafe(F.lit("warmup"))).select("benchmark_run_id")
    of_runs = metrics.drop("architecture").join(runs.select("benchmark_run_id", "architecture", "protocol"), "benchmark_run_id", "inner")
    subject, none = F.col("benchmark_run_id"), F.lit("")
    found = [
        validation.as_violations(attempts, F.col("pair_id"), F.col("rule"), F.col("observed")),
        validation.as_violations(validation.duplicate_keys(metrics, "metric_id"), F.col("metric_id"), "duplicate_metric_id", F.col("occurrences")),
        validation.as_violations(validation.duplicate_keys(metrics.where(
            (F.col("metric_type") == "trino_query") & (F.col("query_id") != "")), "query_id"),
            F.col("query_id"), "duplicate_query_id", F.col("occurrences")),
        validation.as_violations(recorded.join(metrics.select("benchmark_run_id").distinct(), "benchmark_run_id", "left_anti"),
                                 subject, "metrics_missing", none),
        validation.as_violations(validation.rule_violations(of_runs.where(~F.col("protocol").eqNullSafe(F.lit("warmup")))),
                                 F.col("subject"), F.col("rule"), none),
        validation.as_violations(validation.write_inconsistencies(of_runs.where(F.col("protocol") == "pipeline_paired")),
                                 F.concat_ws("/", "architecture", "table_name", "dataset", "year", "month"),
                                 "repeated_write_changed", F.col("versions")),
    ]
    if expected_pairs is not None:
        found.append(validation.as_violations(
            expected_pairs.select("pair_id").distinct().join(members.select("pair_id").distinct(), "pair_id", "left_anti"),
            F.col("pair_id"), "pair_missing", none))
    if artifact_ids is not None:
        key = ["benchmark_run_id", "metric_id"]
        gaps = coverage.coverage_gaps(artifact_ids.join(recorded, "benchmark_run_id", "left_semi"),
                                      metrics.join(recorded, "benchmark_run_id", "left_semi"), key)
        found.append(validation.as_violations(gaps.groupBy("benchmark_run_id").agg(F.count(F.lit(1)).alias("ids")),
                                              subject, "artifact_ids_differ", F.col("ids")))
    if results is not None:
        sides = results.groupBy("run_key").agg(F.count_distinct("architecture").alias("sides"), F.count_distinct(F.struct("result")).alias("versions"))
        found.append(validation.as_violations(sides.where((F.col("sides") < 2) | (F.col("versions") > 1)), F.col("run_key"),
                                              "results_differ", F.concat_ws("/", "sides", "versions")))
    if samples is not None:
        flagged = samples if "is_error" in samples.columns else samples.withColumn("is_error", F.lit(False))
        found.append(validation.evidence_gaps(flagged, runs, windows))
    elif windows is not None:
        found.append(validation.as_violations(windows.where(~F.col("complete")), F.col("block"), "request_datapoints_missing", F.lit("0")))
    return _union(found)


def layout_effect_report(metrics: DataFrame, pair_col: str = "trial_id",
                         measures: Sequence[str] = pairing.LAYOUT_MEASURES,
                         protocols: Sequence[str] = ("warm_recorded", "service_cold_recorded"),
                         accepted_on: str | None = None, resamples: int = stats.BOOTSTRAP_RESAMPLES,
                         members: DataFrame | None = None, expected_pairs: DataFrame | None = None) -> dict[str, DataFrame]:
    """2x2 effects per measure with sequence / cardinality checks.

    With ``members`` (:func:`layout_member_violations`) only metrics of complete
    members count.  A pair that lacks a measure in any cell, or in all four, is a missing pair of it.
    """
    sel = metrics.where((F.col("metric_type") == "trino_query") & F.col("measurement_protocol").isin(*protocols))
    seq = validation.sequence_gaps(metrics, by=["comparison_id"])
    violations = [validation.as_violations(seq.where(~F.col("contiguous")), F.col("comparison_id"),
                                           "sequence_positions", F.col("positions"))]
    if members is not None:
        sel = sel.join(members.where(F.col("status") == "complete").select("benchmark_run_id"), "benchmark_run_id", "left_semi")
        violations = [layout_member_violations(metrics, members, expected_pairs)]
    effects = []
    for m in measures:
        cells = pairing.assemble_cells(sel, m, pair_col=pair_col)
        effects.append(pairing.layout_effects(cells, pair_col=pair_col, resamples=resamples)
                       .withColumn("measure", F.lit(m)))
    found = _union(violations)
    return {"effects": _union(effects), "sequence": seq, "violations": found,
            "verdict": validation.verdict([found], accepted_on, validation.INVALID)}


def layout_member_violations(metrics: DataFrame, members: DataFrame, expected_pairs: DataFrame | None = None) -> DataFrame:
    """C7 cardinality rules as (subject, rule, observed) rows.

    ``members``: (pair_id, architecture, layout, benchmark_run_id, sequence_position,
    status).  A scheduled pair (``expected_pairs``: pair_id) needs members and no other
    pair may have any; a pair has its four cells, once each; a run id occurs once, is
    complete and has query metrics; positions are 1..N.
    """
    cells = len(pairing.LAYOUTS) * 2
    per_pair = members.groupBy("pair_id").agg(F.count(F.lit(1)).alias("members"), F.count_distinct(F.struct("architecture", "layout")).alias("cells"))
    seq = validation.sequence_gaps(members)
    queries = metrics.where(F.col("metric_type") == "trino_query").select("benchmark_run_id").distinct()
    run = F.col("benchmark_run_id")
    found = [
        validation.as_violations(per_pair.where((F.col("members") != cells) | (F.col("cells") != cells)), F.col("pair_id"),
                                 "pair_cells", F.concat_ws("/", "members", "cells")),
        validation.as_violations(validation.duplicate_keys(members, "benchmark_run_id"), run, "duplicate_run_id", F.col("occurrences")),
        validation.as_violations(members.where(~F.col("status").eqNullSafe(F.lit("complete"))), run, "member_incomplete",
                                 F.coalesce("status", F.lit(""))),
        validation.as_violations(members.join(queries, "benchmark_run_id", "left_anti"), run, "query_metrics_missing", F.lit("")),
        validation.as_violations(seq.where(~F.coalesce("contiguous", F.lit(False))), F.lit("members"), "sequence_positions", F.col("positions")),
    ]
    if expected_pairs is not None:
        gaps = coverage.coverage_gaps(expected_pairs, members, ["pair_id"])
        found.append(validation.as_violations(gaps, F.col("pair_id"), F.concat(F.lit("pair_"), F.col("gap")), F.lit("")))
    return _union(found)


def pruning_report(metrics: DataFrame, filtered_query: str, broad_query: str,
                   expected_n: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Broad vs filtered medians, hybrid penalties and headline findings."""
    sel, failed = coverage.select_metrics(metrics, list((expected_n or pairing.PROTOCOL_SAMPLES)),
                                          [filtered_query, broad_query])
    rows = pairing.broad_vs_filtered(sel, filtered_query, broad_query, dict(expected_n or pairing.PROTOCOL_SAMPLES))
    pen = pairing.penalty_narrowing(rows)
    return {"rows": rows, "penalties": pen, "findings": pairing.pruning_findings(rows, pen), "failed_metrics": failed}


# Spark tasks of one pipeline run, and the properties that a profile sets.
SIZING_TASKS = 3
SIZING_PROPERTIES = {"spark.cores.max": "cores_max", "spark.executor.cores": "executor_cores"}


def executor_sizing_report(schedule: DataFrame, members: DataFrame, metrics: DataFrame,
                           artifact_ids: DataFrame | None = None, accepted_on: str | None = None) -> dict[str, DataFrame]:
    """Schedule coverage, run checks, id reconciliation, applied properties, medians and gains.

    ``schedule`` and ``members``: (pair_id, profile, cores_max, executor_cores,
    sequence_position), ``schedule`` with workload_name, ``members`` with
    benchmark_run_id and status; ``metrics``: (benchmark_run_id, metric_id,
    metric_type, status, duration_seconds, spark_properties); ``artifact_ids``: (metric_id).
    Violations: missing, unexpected or differing members, incomplete ones, runs
    without exactly three task metrics or one successful pipeline metric,
    properties that a task did not run with, and metric ids on one side only.
    Medians take scheduled members with a valid pipeline metric.
    """
    key, fields = ["pair_id", "profile"], ["cores_max", "executor_cores", "sequence_position"]
    subject, run = F.concat_ws("/", *key), F.col("benchmark_run_id")
    differ = coverage.results_equivalent(schedule.select(*key, *fields), members.select(*key, *fields), key, default=(0.0, 0.0))
    rule = (F.when(F.col("mismatch") == "missing_right", "member_missing").when(F.col("mismatch") == "missing_left", "member_unexpected")
            .otherwise(F.concat(F.lit("schedule_"), F.col("column"))))
    is_task, is_pipeline = F.col("metric_type") == "airflow_task", F.col("metric_type") == "pipeline"
    per_run = metrics.groupBy("benchmark_run_id").agg(
        F.count_if(is_task).alias("tasks"), F.count_if(is_pipeline).alias("pipelines"),
        F.count_if(is_pipeline & (F.col("status") == "success")).alias("successes"),
        F.max(F.when(is_pipeline, F.col("duration_seconds"))).alias("duration_seconds"))
    runs = members.join(per_run, "benchmark_run_id", "left").na.fill(0, ["tasks", "pipelines", "successes"])
    valid = (F.col("pipelines") == 1) & (F.col("successes") == 1)
    scheduled = members.select("benchmark_run_id", F.inline(F.array(*[
        F.struct(F.lit(name).alias("key"), F.col(c).cast("string").alias("value")) for name, c in SIZING_PROPERTIES.items()])))
    config = validation.property_mismatches(metrics.where(is_task), scheduled)
    violations = [
        validation.as_violations(differ, subject, rule, F.coalesce("right_value", F.lit(""))),
        validation.as_violations(members.where(~F.col("status").eqNullSafe(F.lit("complete"))), subject, "member_incomplete",
                                 F.coalesce("status", F.lit(""))),
        validation.as_violations(runs.where(F.col("tasks") != SIZING_TASKS), run, "task_metrics", F.col("tasks")),
        validation.as_violations(runs.where(~valid), run, "pipeline_metric", F.concat_ws("/", "successes", "pipelines")),
        validation.as_violations(config, F.col("metric_id"), F.concat_ws(":", F.lit("not_applied"), F.col("key")),
                                 F.coalesce("recorded_value", F.lit(""))),
    ]
    if artifact_ids is not None:
        violations.append(validation.as_violations(coverage.reconcile_ids(artifact_ids, metrics, "metric_id"),
                                                   F.col("metric_id"), F.concat(F.lit("metric_id_"), F.col("side")), F.lit("")))
    found = _union(violations)
    records = runs.where(valid).join(schedule.select(*key, "workload_name"), key, "inner")
    medians = coverage.profile_medians(records)
    return {"medians": medians, "gains": coverage.profile_gain(medians), "violations": found,
            "verdict": validation.verdict([found], accepted_on, validation.INVALID)}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
