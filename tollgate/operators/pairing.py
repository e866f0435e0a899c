"""Paired-comparison analytics over run metrics.

The reference pairs measurements with Python dicts on one machine; here
each step is a join or grouped aggregate keyed by the pairing identifiers,
so the work is spread by pair/key and no sample list is collected.
Pivoting uses conditional aggregation (``max(when(cell, v))``) — a single
hash aggregate with map-side partials, no per-value pivot pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.operators.sequence import join_null_safe
from tollgate.operators.stats import (BOOTSTRAP_RESAMPLES, BOOTSTRAP_SEED, QUANTILES, bootstrap_median,
                                      paired_bootstrap, percentage_delta, quantile_columns, quantiles)

# Architectures, layouts and protocol sample sizes.
ARCH_A, ARCH_B = "onprem", "hybrid_aws"
LAYOUTS = ("fragmented", "compact")
PROTOCOL_SAMPLES = {"warm_recorded": 5, "service_cold_recorded": 3}
# Effect names of the 2x2 layout design.
EFFECTS = (
    "onprem_fragmentation_penalty_percent",
    "hybrid_fragmentation_penalty_percent",
    "hybrid_penalty_fragmented_percent",
    "hybrid_penalty_compact_percent",
    "fragmentation_interaction_percentage_points",
)
# Measures summarized by the layout report.
LAYOUT_MEASURES = ("duration_seconds", "planning_time_ms", "physical_input_bytes")


def accepted_members(attempt_members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the single ``complete`` attempt of each pair.

    Input: one row per (pair_id, attempt, member) with ``attempt_status``.
    Returns ``(members, violations)``; a pair with zero or several complete
    attempts yields a violation row and no members.  ``retry_count`` is the
    number of earlier attempts of the pair.
    """
    attempts = attempt_members.groupBy("pair_id", "attempt").agg(
        F.first("attempt_status").alias("attempt_status"))
    per_pair = attempts.groupBy("pair_id").agg(
        F.count_if(F.col("attempt_status") == "complete").alias("complete_attempts"),
        F.max(F.when(F.col("attempt_status") == "complete", F.col("attempt"))).alias("accepted_attempt"),
        F.count(F.lit(1)).alias("attempts"),
    )
    violations = per_pair.where(F.col("complete_attempts") != 1).select(
        "pair_id", F.lit("complete_attempts").alias("rule"),
        F.format_string("expected one complete attempt, found %d", F.col("complete_attempts")).alias("observed"),
    )
    ok = per_pair.where(F.col("complete_attempts") == 1)
    members = attempt_members.join(
        ok.select("pair_id", F.col("accepted_attempt").alias("attempt"), "attempts"),
        ["pair_id", "attempt"], "inner",
    ).withColumn("retry_count", (F.col("attempts") - 1).cast("int")).drop("attempts")
    return members, violations


def metric_key() -> Column:
    """Comparison key of a metric row: pipeline or query scope, else NULL."""
    ds_y_m = F.concat_ws(":", F.col("dataset"), F.col("year").cast("string"), F.col("month").cast("string"))
    return (
        F.when(F.col("metric_type") == "pipeline", F.concat(F.lit("pipeline:"), ds_y_m))
        .when(F.col("metric_type") == "trino_query",
              F.concat(F.lit("query:"), F.col("query_name"), F.lit(":"), ds_y_m))
    )


def scoped_metrics(metrics: DataFrame, members: DataFrame) -> DataFrame:
    """Metrics of accepted members with ``key = protocol:metric_key``.

    Rows without a key or a duration are dropped.
    """
    m = members.select("benchmark_run_id", "pair_id", F.col("protocol").alias("_protocol"),
                       F.col("architecture").alias("_arch"))
    joined = metrics.join(m, "benchmark_run_id", "inner")
    return (
        joined.withColumn("key", F.concat(F.col("_protocol"), F.lit(":"), metric_key()))
        .where(F.col("key").isNotNull() & F.col("duration_seconds").isNotNull())
    )


def pair_by_architecture(scoped: DataFrame, value: str = "duration_seconds",
                         a: str = ARCH_A, b: str = ARCH_B) -> DataFrame:
    """One row per (key, pair) holding both architectures' values.

    When a member reports a key several times the latest report wins
    (latest ``started_at``, ties by ``metric_id``).  Pairs missing either
    architecture are dropped.
    """
    latest = scoped.groupBy("key", "pair_id", "_arch").agg(
        F.max_by(F.col(value), F.struct("started_at", "metric_id")).alias("_v"))
    wide = latest.groupBy("key", "pair_id").agg(
        F.max(F.when(F.col("_arch") == a, F.col("_v"))).alias(a),
        F.max(F.when(F.col("_arch") == b, F.col("_v"))).alias(b),
    )
    return wide.where(F.col(a).isNotNull() & F.col(b).isNotNull())


def paired_summary(pairs: DataFrame, a: str = ARCH_A, b: str = ARCH_B) -> DataFrame:
    """A18 per side + median paired delta, per key — one sort by rank for all three."""
    both = pairs.select("key", F.col(a).alias("a"), F.col(b).alias("b"), percentage_delta(F.col(a), F.col(b)).alias("delta"))
    out = quantiles(both, ["key"], {"a": QUANTILES, "b": QUANTILES, "delta": (0.5,)})
    return out.select("key", *quantile_columns(F.col("a.n"), F.col("a.q"), f"{a}_"), *quantile_columns(F.col("b.n"), F.col("b.q"), f"{b}_"),
                      F.col("delta.q")[0].alias("median_paired_delta_percent"))


def paired_intervals(pairs: DataFrame, a: str = ARCH_A, b: str = ARCH_B,
                     seed: int = BOOTSTRAP_SEED, resamples: int = BOOTSTRAP_RESAMPLES) -> DataFrame:
    """T1 over J2 output: per-key bootstrap CI of the median paired delta."""
    return paired_bootstrap(pairs, ["key"], a, b, ["pair_id"], seed, resamples)


def assemble_cells(metrics: DataFrame, value: str, pair_col: str = "layout_pair_id",
                   key_cols: Sequence[str] = ("measurement_protocol", "query_name")) -> DataFrame:
    """The four (architecture, layout) values of each pair and key.

    Output has one column per cell (``onprem_fragmented`` ...) and
    ``complete`` = all four present.
    """
    keys = [*key_cols, pair_col]
    latest = metrics.groupBy(*keys, "architecture", "file_layout").agg(
        F.max_by(F.col(value), F.struct("started_at", "metric_id")).alias("_v"))
    cells = {}
    for arch in (ARCH_A, ARCH_B):
        for layout in LAYOUTS:
            cells[f"{arch}_{layout}"] = F.max(F.when(
                (F.col("architecture") == arch) & (F.col("file_layout") == layout), F.col("_v")))
    wide = latest.groupBy(*keys).agg(*[c.cast("double").alias(n) for n, c in cells.items()])
    complete = F.lit(True)
    for n in cells:
        complete = complete & F.col(n).isNotNull()
    return wide.withColumn("complete", complete)


def layout_effect_rows(cells: DataFrame, key_cols: Sequence[str] = ("measurement_protocol", "query_name"),
                       pair_col: str = "layout_pair_id") -> DataFrame:
    """Long rows (keys, pair, effect, value) from complete 2x2 pairs.

    A zero base drops only the affected effect (and the interaction when
    either fragmentation penalty is undefined).
    """
    c = cells.where("complete")
    of, oc = F.col("onprem_fragmented"), F.col("onprem_compact")
    hf, hc = F.col("hybrid_aws_fragmented"), F.col("hybrid_aws_compact")
    op, hp = percentage_delta(oc, of), percentage_delta(hc, hf)
    values = [op, hp, percentage_delta(of, hf), percentage_delta(oc, hc), hp - op]
    entries = F.array(*[F.struct(F.lit(n).alias("effect"), v.alias("value")) for n, v in zip(EFFECTS, values)])
    return (
        c.select(*key_cols, pair_col, F.inline(entries))
        .where(F.col("value").isNotNull())
    )


def layout_effects(cells: DataFrame, key_cols: Sequence[str] = ("measurement_protocol", "query_name"),
                   pair_col: str = "layout_pair_id", seed: int = BOOTSTRAP_SEED,
                   resamples: int = BOOTSTRAP_RESAMPLES) -> DataFrame:
    """Per (keys, effect) median effect with bootstrap CI, plus pair counts."""
    rows = layout_effect_rows(cells, key_cols, pair_col)
    boot = bootstrap_median(rows, [*key_cols, "effect"], "value", [pair_col], seed, resamples)
    counts = cells.groupBy(*key_cols).agg(
        F.count_if("complete").alias("complete_pairs"),
        F.count_if(~F.col("complete")).alias("missing_pairs"),
    )
    return boot.join(counts, list(key_cols), "left")


def broad_vs_filtered(metrics: DataFrame, filtered_query: str, broad_query: str,
                      expected_n: dict[str, int] | None = None) -> DataFrame:
    """J4 + T4: per (protocol, architecture, dataset, year, month) the
    filtered-query medians against the dataset's broad-scan medians, with
    latency and physical-input reductions.

    ``n_ok`` flags groups whose sample sizes equal the protocol's expected
    count (5 warm / 3 cold by default); the broad scan's month is only a
    label, so broad samples are pooled per dataset-year.
    """
    expected_n = expected_n or PROTOCOL_SAMPLES
    keys = ["measurement_protocol", "architecture", "dataset", "year"]
    sel = metrics.where(
        (F.col("metric_type") == "trino_query")
        & F.col("measurement_protocol").isin(*expected_n)
    )

    def medians(query: str, by: list[str], side: str) -> DataFrame:
        of = sel.where(F.col("query_name") == query)
        counts = of.groupBy(*by).agg(F.count(F.lit(1)).alias(f"n_{side}"))
        middle = quantiles(of, by, {"duration_seconds": (0.5,), "physical_input_bytes": (0.5,)})
        return join_null_safe(counts, middle, by).select(
            *by, f"n_{side}", F.col("duration_seconds")["q"][0].alias(f"{side}_latency_median_seconds"),
            F.col("physical_input_bytes")["q"][0].alias(f"{side}_physical_input_bytes"))

    broad = medians(broad_query, keys, "broad")
    filt = medians(filtered_query, [*keys, "month"], "filtered")
    expected = F.coalesce(*[F.when(F.col("measurement_protocol") == p, F.lit(n)) for p, n in expected_n.items()])
    reduction = lambda b, f: F.when(F.col(b) != 0, (F.col(b) - F.col(f)) / F.col(b) * 100)
    return filt.join(broad, keys, "inner").select(
        *keys, "month", "n_broad", "n_filtered",
        ((F.col("n_broad") == expected) & (F.col("n_filtered") == expected)).alias("n_ok"),
        "broad_latency_median_seconds", "filtered_latency_median_seconds",
        reduction("broad_latency_median_seconds", "filtered_latency_median_seconds").alias("latency_reduction_percent"),
        "broad_physical_input_bytes", "filtered_physical_input_bytes",
        reduction("broad_physical_input_bytes", "filtered_physical_input_bytes").alias("physical_input_reduction_percent"),
    )


def penalty_narrowing(rows: DataFrame, a: str = ARCH_A, b: str = ARCH_B) -> DataFrame:
    """J5 + T4: hybrid penalty of broad and filtered medians and their difference (pp)."""
    keys = ["measurement_protocol", "dataset", "year", "month"]
    w = rows.groupBy(*keys).agg(
        F.max(F.when(F.col("architecture") == a, F.col("broad_latency_median_seconds"))).alias("_ab"),
        F.max(F.when(F.col("architecture") == b, F.col("broad_latency_median_seconds"))).alias("_bb"),
        F.max(F.when(F.col("architecture") == a, F.col("filtered_latency_median_seconds"))).alias("_af"),
        F.max(F.when(F.col("architecture") == b, F.col("filtered_latency_median_seconds"))).alias("_bf"),
    ).where(F.col("_ab").isNotNull() & F.col("_bb").isNotNull() & F.col("_af").isNotNull() & F.col("_bf").isNotNull())
    bp = percentage_delta(F.col("_ab"), F.col("_bb"))
    fp = percentage_delta(F.col("_af"), F.col("_bf"))
    return w.select(
        *keys,
        bp.alias("broad_hybrid_penalty_percent"),
        fp.alias("filtered_hybrid_penalty_percent"),
        (bp - fp).alias("hybrid_penalty_narrowing_percentage_points"),
    )


def pruning_findings(rows: DataFrame, penalties: DataFrame, b: str = ARCH_B) -> DataFrame:
    """Headline ranges and improved-case counts (one row)."""
    effects = {"physical_input_reduction_percent": "input_reduction", "latency_reduction_percent": "latency_reduction"}
    narrowing = {"hybrid_penalty_narrowing_percentage_points": "narrowing"}

    def ranges(df: DataFrame, named: dict[str, str], *counts: Column) -> DataFrame:
        q = quantiles(df, [], {c: (0, 0.5, 1) for c in named}).select(
            *[F.col(c)["q"][i].alias(f"{n}_{what}") for c, n in named.items() for i, what in enumerate(("min", "median", "max"))])
        return q.withColumn("_k", F.lit(1)).join(df.agg(*counts).withColumn("_k", F.lit(1)), "_k").drop("_k")

    r = ranges(
        rows, effects,
        F.count_if(F.col("latency_reduction_percent") > 0).alias("latency_improved_cases"),
        F.count(F.lit(1)).alias("latency_case_count"),
        F.count_if((F.col("architecture") == b) & (F.col("latency_reduction_percent") > 0)).alias("hybrid_latency_improved_cases"),
        F.count_if(F.col("architecture") == b).alias("hybrid_latency_case_count"),
    )
    p = ranges(
        penalties, narrowing,
        F.count_if(F.col("hybrid_penalty_narrowing_percentage_points") > 0).alias("hybrid_penalty_narrowed_cases"),
        F.count(F.lit(1)).alias("hybrid_penalty_case_count"),
    )
    # Both sides are single-row global aggregates: join on a constant key.
    return r.withColumn("_k", F.lit(1)).join(p.withColumn("_k", F.lit(1)), "_k").drop("_k")


# Names used in the operator inventory.
penalty = penalty_narrowing
findings = pruning_findings
