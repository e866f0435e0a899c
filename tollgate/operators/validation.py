"""Evidence validation rules (V7-V14) as violation DataFrames.

Each rule returns rows describing violations (empty = satisfied) instead of
raising from inside a loop; ``verdict`` folds any number of violation
frames into the acceptance status.  Every rule is a single grouped
aggregate or join — nothing is collected except the final verdict row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.sources.adapters import TASK_IDS

VIOLATION_COLUMNS = ("subject", "rule", "observed")


def as_violations(df: DataFrame, subject: Column, rule: str | Column, observed: Column) -> DataFrame:
    rule_col = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(subject.cast("string").alias("subject"), rule_col.alias("rule"),
                     observed.cast("string").alias("observed"))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """V7: keys occurring more than once, with their multiplicity."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def write_inconsistencies(metrics: DataFrame,
                          by: Sequence[str] = ("architecture", "table_name", "dataset", "year", "month"),
                          values: Sequence[str] = ("records_read", "file_count")) -> DataFrame:
    """V8: repeated writes of one partition must record identical counts.

    Per group of partition-layout metric rows, the number of distinct
    ``(records_read, file_count)`` combinations (NULL counts as a value).
    """
    layout = metrics.where(F.col("metric_type") == "iceberg_partition")
    return (
        layout.groupBy(*by).agg(
            F.count(F.lit(1)).alias("writes"),
            F.count_distinct(F.struct(*values)).alias("versions"),
        ).where((F.col("writes") >= 2) & (F.col("versions") > 1))
    )


def sequence_gaps(df: DataFrame, column: str = "sequence_position", by: Sequence[str] = ()) -> DataFrame:
    """V9: positions must be exactly the unique contiguous range 1..N."""
    agg = df.groupBy(*by).agg(
        F.min(column).alias("min_position"), F.max(column).alias("max_position"),
        F.count(column).alias("positions"), F.count_distinct(column).alias("distinct_positions"),
    )
    ok = ((F.col("min_position") == 1) & (F.col("max_position") == F.col("positions"))
          & (F.col("distinct_positions") == F.col("positions")))
    return agg.withColumn("contiguous", ok)


def metric_rules() -> list[tuple[str, Column]]:
    """Per-row requirements of run metrics (fixed rule set)."""
    mt = F.col("metric_type")
    return [
        ("query_id_required", (mt == "trino_query") & (F.coalesce(F.col("query_id"), F.lit("")) == "")),
        ("query_finished", (mt == "trino_query") & (F.upper(F.coalesce(F.col("status"), F.lit(""))) != "FINISHED")),
        ("pipeline_success", (mt == "pipeline") & (F.lower(F.coalesce(F.col("status"), F.lit(""))) != "success")),
        ("spark_application_id_required",
         (mt == "airflow_task") & F.col("task_id").isin(*TASK_IDS)
         & (F.coalesce(F.col("spark_application_id"), F.lit("")) == "")),
        ("positive_duration", F.col("duration_seconds").isNotNull() & (F.col("duration_seconds") <= 0)),
    ]


def rule_violations(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None,
                    subject: str = "metric_id") -> DataFrame:
    """One row per (row, violated rule), evaluated in a single pass."""
    rules = list(rules) if rules is not None else metric_rules()
    flags = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(p, F.lit(False)).alias("bad")) for n, p in rules])
    return (
        df.select(F.col(subject).cast("string").alias("subject"), F.inline(flags))
        .where("bad").select("subject", "rule")
    )


def cardinality_violations(df: DataFrame, by: Sequence[str], expected: int | Column,
                           expected_groups: DataFrame | None = None) -> DataFrame:
    """Groups whose row count differs from ``expected``.

    With ``expected_groups`` (the design grid), groups with no rows at all
    are reported too (count 0).
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("observed"))
    if expected_groups is not None:
        counts = expected_groups.select(*by).distinct().join(counts, list(by), "left") \
            .withColumn("observed", F.coalesce("observed", F.lit(0)))
    exp = F.lit(expected) if isinstance(expected, int) else expected
    return counts.withColumn("expected", exp).where(F.col("observed") != F.col("expected"))


def evidence_gaps(samples: DataFrame, members: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Members without resource samples or with sampling errors, and
    request windows without any datapoint.

    ``samples``: (benchmark_run_id, is_error boolean) one row per sample or
    sampling error; ``windows``: output of ``points_in_windows`` summary
    (block, complete).
    """
    per = samples.groupBy("benchmark_run_id").agg(
        F.count_if(~F.col("is_error")).alias("samples"), F.count_if(F.col("is_error")).alias("errors"))
    m = members.select("benchmark_run_id").distinct().join(per, "benchmark_run_id", "left")
    missing = as_violations(m.where(F.coalesce("samples", F.lit(0)) == 0), F.col("benchmark_run_id"),
                            "resource_samples_missing", F.lit("0"))
    errors = as_violations(m.where(F.col("errors") > 0), F.col("benchmark_run_id"),
                           "resource_sampling_errors", F.col("errors"))
    out = missing.unionByName(errors)
    if windows is not None:
        out = out.unionByName(as_violations(windows.where(~F.col("complete")), F.col("block"),
                                            "request_datapoints_missing", F.lit("0")))
    return out


def config_mismatches(recorded: DataFrame, scheduled: DataFrame, by: Sequence[str] = ("benchmark_run_id",)) -> DataFrame:
    """Scheduled property values that were not applied.

    Both inputs are long (by..., key, value).  A scheduled key that is
    missing from the recorded properties, or recorded with another value,
    is a violation.
    """
    keys = [*by, "key"]
    rec = recorded.select(*keys, F.col("value").alias("recorded_value"))
    return (
        scheduled.select(*keys, F.col("value").alias("scheduled_value"))
        .join(rec, keys, "left")
        .where(F.col("recorded_value").isNull() | (F.col("recorded_value") != F.col("scheduled_value")))
    )


def property_mismatches(tasks: DataFrame, scheduled: DataFrame, pairs: str = "spark_properties",
                        subject: str = "metric_id", by: Sequence[str] = ("benchmark_run_id",)) -> DataFrame:
    """V13 on recorded property lists: scheduled values that a task did not run with.

    ``pairs`` holds a task's ``[[key, value], ...]``; of a repeated key the last
    pair counts.  ``scheduled``: long (by..., key, value).  Every task is checked
    against every scheduled key of its run; a task without the key, or without
    a list, has recorded NULL.  The lists are looked up in place, not exploded.
    """
    wanted = scheduled.select(*by, "key", F.col("value").alias("scheduled_value"))
    named = F.filter(F.col(pairs), lambda pair: F.get(pair, F.lit(0)) == F.col("key"))
    recorded = F.get(F.try_element_at(named, F.lit(-1)), F.lit(1))
    return (
        tasks.select(subject, *by, pairs).join(wanted, list(by), "inner")
        .select(subject, *by, "key", "scheduled_value", recorded.alias("recorded_value"))
        .where(~F.col("recorded_value").eqNullSafe(F.col("scheduled_value")))
    )


# Acceptance status texts.
BLOCKED = "ACCEPTANCE BLOCKED"
INVALID = "INVALID"
READY = "READY FOR MANUAL ACCEPTANCE"


def verdict(violations: Sequence[DataFrame], accepted_on: str | None = None,
            blocked_label: str = BLOCKED) -> DataFrame:
    """One row — status and violation count over all violation frames."""
    if not violations:
        raise ValueError("verdict needs at least one violation frame")
    total = reduce(DataFrame.unionAll, [v.select(F.lit(1).alias("_one")) for v in violations]).agg(F.count("_one").alias("n"))
    accepted = F.lit(f"ACCEPTED {accepted_on}") if accepted_on else F.lit(READY)
    return total.select(
        F.col("n").alias("violations"),
        F.when(F.col("n") > 0, F.lit(blocked_label)).otherwise(accepted).alias("status"),
    )
