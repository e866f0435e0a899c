"""Design coverage, reconciliation and equivalence.

The design grid (trials x targets x protocol executions x cells) is built
with ``explode`` over literal arrays attached to each target row — the
targets come from data, the dimensions are the design parameters — so the
grid never needs a cross join and its size is exactly the design size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.scalar import seconds_between
from tollgate.operators.sequence import dense_index
from tollgate.operators.stats import descriptive, quantiles


def select_partitions(parts: DataFrame, dataset: str | None = None, year: int | None = None,
                      month: int | None = None, require: bool = False) -> DataFrame:
    """NULL parameter = no restriction.  With ``require`` an empty selection is an error."""
    out = parts
    for col, val in (("dataset", dataset), ("year", year), ("month", month)):
        if val is not None:
            out = out.where(F.col(col) == F.lit(val))
    if require and out.isEmpty():
        raise ValueError(f"No partitions selected for dataset={dataset}, year={year}, month={month}")
    return out


def select_metrics(metrics: DataFrame, protocols: Sequence[str], queries: Sequence[str],
                   metric_type: str = "trino_query") -> tuple[DataFrame, DataFrame]:
    """Query metrics of the allowed protocols/queries, plus the
    non-FINISHED rows among them (which invalidate the analysis)."""
    sel = metrics.where(
        (F.col("metric_type") == metric_type)
        & F.col("measurement_protocol").isin(*protocols)
        & F.col("query_name").isin(*queries)
    )
    bad = sel.where(F.coalesce(F.col("status"), F.lit("")) != "FINISHED")
    return sel, bad


def coverage_gaps(expected: DataFrame, observed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected keys never observed and observed keys never expected; NULL equals NULL.

    One aggregate over both sides: keys group NULLs together, so no join is needed."""
    return _one_sided(expected, observed, key).select(
        *key, F.when(F.col("_in_left"), "missing").otherwise("unexpected").alias("gap"))


def reconcile_ids(left: DataFrame, right: DataFrame, key: str,
                  left_name: str = "artifact", right_name: str = "table") -> DataFrame:
    """Symmetric difference of ids; a NULL id on both sides agrees."""
    return _one_sided(left, right, [key]).select(
        key, F.when(F.col("_in_left"), f"only_{left_name}").otherwise(f"only_{right_name}").alias("side"))


def _one_sided(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys that one side alone has, with ``_in_left``."""
    tagged = left.select(*key, F.lit(True).alias("_in_left")).unionByName(right.select(*key, F.lit(False).alias("_in_left")))
    return (tagged.groupBy(*key).agg(F.max("_in_left").alias("_any_left"), F.min("_in_left").alias("_in_left"))
            .where(F.col("_any_left") == F.col("_in_left")).drop("_any_left"))


def values_close(a: Column, b: Column, kind: T.DataType, rel: float, abs_: float) -> Column:
    """Whether two values of type ``kind`` agree; never NULL.

    Numbers agree within ``max(rel * max(|a|, |b|), abs)`` (NaN equals NaN, an
    infinity itself only); structs, arrays and maps agree if their parts do, all
    else if equal.  NULL equals NULL and nothing else, at any depth.
    """
    both = a.isNotNull() & b.isNotNull()
    if isinstance(kind, T.NumericType):
        x, y = a.cast("double"), b.cast("double")
        apart = F.abs(x - y)
        near = (x == y) | (~F.isnan(apart) & (apart <= F.greatest(F.lit(rel) * F.greatest(F.abs(x), F.abs(y)), F.lit(abs_)))
                           & (apart != F.lit(float("inf"))))
    elif isinstance(kind, T.StructType):
        near = F.lit(True)
        for f in kind.fields:
            near = near & values_close(a.getField(f.name), b.getField(f.name), f.dataType, rel, abs_)
    elif isinstance(kind, T.ArrayType):
        same = F.forall(F.zip_with(a, b, lambda x, y: values_close(x, y, kind.elementType, rel, abs_)), lambda ok: ok)
        near = (F.size(a) == F.size(b)) & same
    elif isinstance(kind, T.MapType):
        same = F.forall(F.map_keys(a), lambda k: F.map_contains_key(b, k) & values_close(
            F.try_element_at(a, k), F.try_element_at(b, k), kind.valueType, rel, abs_))
        near = (F.size(a) == F.size(b)) & same
    else:
        near = a == b
    return (a.isNull() & b.isNull()) | (both & F.coalesce(near, F.lit(False)))


def _common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type to compare by: numbers of different types compare as doubles."""
    if left != right and isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return T.DoubleType()
    return left


def _mismatches(joined: DataFrame, keys: Sequence[Column], left: T.StructType, right: T.StructType, columns: Sequence[str],
                tolerances: Mapping[str, tuple[float, float]], default: tuple[float, float]) -> DataFrame:
    """Rows of a full outer join (structs ``_l`` and ``_r``) -> one row per missing side or differing column."""
    text = T.StringType()
    checks = []
    for c in columns:
        a, b = F.col("_l").getField(c), F.col("_r").getField(c)
        kind = _common_type(left[c].dataType, right[c].dataType)
        checks.append(F.struct(F.lit("value").alias("mismatch"), F.lit(c).alias("column"),
                               a.cast(text).alias("left_value"), b.cast(text).alias("right_value"),
                               values_close(a, b, kind, *tolerances.get(c, default)).alias("ok")))
    none = F.lit(None).cast(text)
    side = F.when(F.col("_l").isNull(), "missing_left").when(F.col("_r").isNull(), "missing_right")
    gone = F.array(F.struct(side.alias("mismatch"), none.alias("column"), none.alias("left_value"), none.alias("right_value"), F.lit(False).alias("ok")))
    values = F.filter(F.array(*checks), lambda x: ~x["ok"]) if checks else F.filter(gone, lambda x: F.lit(False))
    return joined.select(*keys, F.inline(F.when(side.isNotNull(), gone).otherwise(values))).drop("ok")


def results_equivalent(left: DataFrame, right: DataFrame, keys: Sequence[str],
                       tolerances: Mapping[str, tuple[float, float]] | None = None,
                       default: tuple[float, float] = (1e-9, 1e-6)) -> DataFrame:
    """Per-key mismatches between two result sets, from one full outer join.

    Values compare by :func:`values_close` (per-column ``tolerances`` override
    the default).  NULL keys equal NULL keys.  Keys present on one side only are
    reported as ``missing_left`` / ``missing_right``.  Empty output = equivalent.
    """
    keys = list(keys)
    value_cols = [c for c in left.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*keys).alias(f"{name}k"), F.struct(*keys, *value_cols).alias(name))

    joined = side(left, "_l").join(side(right, "_r"), F.col("_lk").eqNullSafe(F.col("_rk")), "full_outer")
    out = [F.coalesce(F.col("_lk"), F.col("_rk")).getField(k).alias(k) for k in keys]
    return _mismatches(joined, out, left.schema, right.schema, value_cols, dict(tolerances or {}), default)


def _is_approximate(kind: T.DataType) -> bool:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return True
    if isinstance(kind, T.StructType):
        return any(_is_approximate(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _is_approximate(kind.elementType)
    return isinstance(kind, T.MapType)


def _order_of(column: str, kind: T.DataType) -> Column:
    """What a column sorts by; maps, which have no order, by their sorted entries."""
    c = F.col(column)
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    return F.to_json(c) if "map<" in kind.simpleString() else c


def row_mismatches(left: DataFrame, right: DataFrame, tolerances: Mapping[str, tuple[float, float]] | None = None,
                   default: tuple[float, float] = (1e-9, 1e-6)) -> DataFrame:
    """J9 keyless form: two row multisets paired in sorted order, and where pairs differ.

    Rows that agree in all exact columns are sorted by the others and paired
    position by position; values compare by :func:`values_close`, so two numbers
    within tolerance never fall on two sides of a rounding border.  Repeated rows
    pair one to one.  Positions come from range partitions, so no group of equal
    rows meets in one task.  Output: position, mismatch, column, left_value, right_value.
    """
    columns = left.columns
    loose = [c for c in columns if _is_approximate(left.schema[c].dataType)]
    exact = [c for c in columns if c not in loose]

    def placed(df: DataFrame, name: str) -> DataFrame:
        group = F.struct(F.lit(0).alias("_none"), *[F.col(c) for c in exact])
        order = [_order_of(c, left.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(loose)]
        rows = df.select(group.alias("_g"), *order, F.struct(*columns).alias(name))
        at = dense_index(rows, ["_g"], [f"_o{i}" for i in range(len(loose))], name="position")
        return at.select(F.col("_g").alias(f"{name}g"), F.col("position").alias(f"{name}p"), name)

    joined = placed(left, "_l").join(placed(right.select(*columns), "_r"), F.col("_lg").eqNullSafe(F.col("_rg")) & (F.col("_lp") == F.col("_rp")), "full_outer")
    return _mismatches(joined, [F.coalesce("_lp", "_rp").alias("position")], left.schema, right.schema, columns, dict(tolerances or {}), default)


def rows_equivalent(left: DataFrame, right: DataFrame, tolerance: tuple[float, float] = (1e-9, 1e-6)) -> bool:
    """Whether two row multisets agree (see :func:`row_mismatches`); one job."""
    return row_mismatches(left, right, default=tolerance).isEmpty()


def expand_targets(queries: DataFrame, partitions: DataFrame) -> DataFrame:
    """J12 targets: partition-scope queries run on every declared partition,
    dataset-scope queries once per dataset (its first declared partition).

    ``queries``: (query_name, scope); ``partitions``: (dataset, year, month,
    position).  An equi-join on ``scope`` against the partition list tagged
    per scope — the fan-out is exactly the design size, no cross join.
    """
    from tollgate.operators.sequence import first_per_group

    per_partition = partitions.select("dataset", "year", "month", F.lit("partition").alias("scope"))
    per_dataset = first_per_group(partitions.select("dataset", "year", "month", "position"),
                                  ["dataset"], ["position"]).select(
        "dataset", "year", "month", F.lit("dataset").alias("scope"))
    targets = queries.join(per_partition.unionByName(per_dataset), "scope", "inner")
    return targets.select(
        F.format_string("%s_%s_%d_%02d", F.col("query_name"), F.col("dataset"), F.col("year"), F.col("month")).alias("name"),
        "query_name", "dataset", "year", "month", "scope")


def coverage_grid(targets: DataFrame, protocols: Mapping[str, int], trials: int,
                  cells: Sequence[tuple[str, str]]) -> DataFrame:
    """Expected (trial, target, protocol, execution, cell) members."""
    proto = F.array(*[F.struct(F.lit(p).alias("protocol"), F.lit(int(n)).alias("executions"))
                      for p, n in protocols.items()])
    cell = F.array(*[F.struct(F.lit(a).alias("architecture"), F.lit(lay).alias("layout")) for a, lay in cells])
    return (
        targets
        .withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(int(trials)))))
        .select("*", F.inline(proto))
        .where(F.col("executions") > 0)
        .withColumn("execution", F.explode(F.sequence(F.lit(1), F.col("executions"))))
        .select("*", F.inline(cell))
        .drop("executions")
    )


def expected_counts(grid: DataFrame, target_cols: Sequence[str]) -> DataFrame:
    """Expected pairs (grid without cells) and members (with cells)."""
    pair_cols = [*target_cols, "trial", "protocol", "execution"]
    return grid.agg(
        F.count_distinct(*[F.col(c) for c in pair_cols]).alias("expected_pairs"),
        F.count(F.lit(1)).alias("expected_members"),
    )


def run_progress(attempt_members: DataFrame, expected: DataFrame) -> DataFrame:
    """Completed / failed pairs, completed / running members, progress %.

    ``expected`` is the one-row output of :func:`expected_counts`.
    """
    attempts = attempt_members.groupBy("pair_id", "attempt").agg(F.first("attempt_status").alias("attempt_status"))
    pa = attempts.agg(
        F.count(F.lit(1)).alias("scheduled_pairs"),
        F.count_if(F.col("attempt_status") == "complete").alias("completed_pairs"),
        F.count_if(F.col("attempt_status") == "failed").alias("failed_pairs"),
    )
    status = F.coalesce(F.col("member_status"), F.col("attempt_status")) \
        if "member_status" in attempt_members.columns else F.col("attempt_status")
    ma = attempt_members.agg(
        F.count(F.lit(1)).alias("scheduled_members"),
        F.count_if(status == "complete").alias("completed_members"),
        F.count_if(status == "running").alias("running_members"),
    )
    one = lambda d: d.withColumn("_k", F.lit(1))  # noqa: E731  (single-row frames)
    out = one(pa).join(one(ma), "_k").join(one(expected), "_k").drop("_k")
    return out.select(
        "expected_pairs", "scheduled_pairs", "completed_pairs", "failed_pairs",
        "expected_members", "scheduled_members", "completed_members", "running_members",
        F.when(F.col("expected_members") > 0, F.col("completed_members") / F.col("expected_members") * 100)
        .otherwise(F.lit(0.0)).alias("progress_percent"),
    )


# Exit code of each classified result.
RUN_RESULTS = {"complete": 0, "running": 1, "invalid": 2, "orphaned": 3, "unknown": 3}


def run_status(states: DataFrame, attempt_members: DataFrame, expected: DataFrame,
               by: str = "comparison_id", now: Column | None = None) -> DataFrame:
    """Progress and classification of many runs at once, one row per run.

    ``states``: (by, status, runner_active, created_at, finished_at), one row per
    run; ``attempt_members``: (by, pair_id, attempt, position, attempt_status,
    member_status), NULL ``member_status`` for an attempt without members;
    ``expected``: (by, expected_pairs, expected_members).  A running state without
    an active runner is ``orphaned``.  ``current_pair`` is the pair of the attempt
    with the largest ``position`` (ties: largest pair and attempt).  Unfinished
    runs elapse until ``now``; a run without ``created_at`` has no elapsed time.
    Runs without attempts have zero counts; runs without expectation expect nothing.
    """
    member = F.col("member_status")
    attempts = attempt_members.groupBy(by, "pair_id", "attempt").agg(
        F.max("attempt_status").alias("attempt_status"), F.max("position").alias("position"), F.count(member).alias("members"),
        F.count_if(member == "complete").alias("complete"), F.count_if(member == "running").alias("running"), F.count_if(member == "failed").alias("failed"))
    per_run = attempts.groupBy(by).agg(
        F.count(F.lit(1)).alias("scheduled_pairs"),
        F.count_if(F.col("attempt_status") == "complete").alias("completed_pairs"),
        F.count_if(F.col("attempt_status") == "failed").alias("failed_pairs"),
        F.sum("members").alias("scheduled_members"), F.sum("complete").alias("completed_members"),
        F.sum("running").alias("running_members"), F.sum("failed").alias("failed_members"),
        F.max_by("pair_id", F.struct("position", "pair_id", "attempt")).alias("current_pair"))
    counts = ["scheduled_pairs", "completed_pairs", "failed_pairs", "scheduled_members", "completed_members", "running_members", "failed_members"]
    joined = states.join(expected, by, "left").join(per_run, by, "left").na.fill(0, ["expected_pairs", "expected_members", *counts])
    status, active = F.col("status"), F.coalesce(F.col("runner_active"), F.lit(False))
    result = (F.when(status.isin("complete", "dry_run_complete"), "complete").when(status.isin("invalid", "failed"), "invalid")
              .when((status == "running") & active, "running").when(status == "running", "orphaned").otherwise("unknown"))
    codes = F.create_map(*[F.lit(x) for pair in RUN_RESULTS.items() for x in pair])
    end = F.coalesce(F.col("finished_at"), now if now is not None else F.current_timestamp())
    done = F.col("completed_members")
    return joined.withColumn("result", result).select(
        by, F.coalesce(status, F.lit("unknown")).alias("state_status"), "result", codes[F.col("result")].alias("exit_code"),
        "expected_pairs", *counts[:3], "expected_members", *counts[3:],
        F.greatest(F.col("expected_members") - done - F.col("running_members") - F.col("failed_members"), F.lit(0)).alias("pending_members"),
        F.when(F.col("expected_members") > 0, done / F.col("expected_members") * 100).otherwise(F.lit(0.0)).alias("progress_percent"),
        "current_pair",
        F.when(F.col("created_at").isNotNull(), F.greatest(seconds_between(F.col("created_at"), end), F.lit(0.0))).alias("elapsed_seconds"))


def profile_medians(runs: DataFrame, by: Sequence[str] = ("workload_name", "profile"),
                    value: str = "duration_seconds") -> DataFrame:
    """Runs per (workload, profile): n, min, median, max."""
    out = quantiles(runs, by, {value: (0, 0.5, 1)})
    q = F.col(value)["q"]
    return out.select(*by, F.col(value)["n"].alias("n"), q[0].alias("min_seconds"), q[1].alias("median_seconds"), q[2].alias("max_seconds"))


def profile_gain(medians: DataFrame, workload: str = "workload_name",
                 small: str = "small", medium: str = "medium", default: str = "default") -> DataFrame:
    """Scaling gains between profiles, only when all three exist."""
    w = medians.groupBy(workload).agg(*[
        F.max(F.when(F.col("profile") == p, F.col("median_seconds"))).alias(p) for p in (small, medium, default)
    ]).where(F.col(small).isNotNull() & F.col(medium).isNotNull() & F.col(default).isNotNull())
    return w.select(
        workload, small, medium, default,
        F.when(F.col(small) != 0, (F.col(small) - F.col(medium)) / F.col(small) * 100).alias("small_to_medium_gain_percent"),
        F.when(F.col(medium) != 0, (F.col(medium) - F.col(default)) / F.col(medium) * 100).alias("medium_to_default_gain_percent"),
    )


def prep_time_summary(jobs: DataFrame, cell: str = "cell", value: str = "elapsed_seconds") -> DataFrame:
    """Descriptive preparation time per cell ("unavailable" without timings)."""
    d = descriptive(jobs.where(F.col(value).isNotNull()), [cell], value)
    return d.withColumn("claim", F.when(F.col("n") > 0, F.lit("descriptive_only")).otherwise(F.lit("unavailable")))
