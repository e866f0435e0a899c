"""Registered queries over run metrics (comparisons, effects, statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators import pairing, stats
from tollgate.plans import oracle
from tollgate.plans.registry import register, rnd
from tollgate.session import pin
from tollgate.sources.adapters import BROAD_QUERY, FILTERED_QUERY, run_metrics

SEED = stats.BOOTSTRAP_SEED


def _rm(spark, sf) -> DataFrame:
    pin(spark)
    return run_metrics(spark, sf)


register("run_metrics", oracle.with_metrics("SELECT * FROM run_metrics"))(_rm)


# ---------------------------------------------------------------------------
# attempts / members (W4) and pairing
# ---------------------------------------------------------------------------

def attempt_members(rm: DataFrame) -> DataFrame:
    """Attempt membership derived from metrics: pair = dag run, attempt =
    retry number; the second attempt is the complete one."""
    return rm.groupBy(
        F.col("dag_run_id").alias("pair_id"), F.col("retry_count").alias("attempt"),
        "benchmark_run_id", "architecture", F.col("measurement_protocol").alias("protocol"),
    ).agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at")).withColumn(
        "attempt_status", F.when(F.col("attempt") == 1, F.lit("complete")).otherwise(F.lit("failed")))


ATTEMPTS_SQL = """
attempt_members AS (
  SELECT dag_run_id AS pair_id, retry_count AS attempt, benchmark_run_id, architecture,
         measurement_protocol AS protocol, min(started_at) AS started_at, max(finished_at) AS finished_at,
         CASE WHEN retry_count = 1 THEN 'complete' ELSE 'failed' END AS attempt_status
  FROM run_metrics GROUP BY dag_run_id, retry_count, benchmark_run_id, architecture, measurement_protocol
),
per_pair AS (
  SELECT pair_id, CAST(sum(CASE WHEN attempt_status = 'complete' THEN 1 ELSE 0 END) AS BIGINT) AS complete_attempts,
         max(CASE WHEN attempt_status = 'complete' THEN attempt END) AS accepted_attempt, count(*) AS attempts
  FROM (SELECT DISTINCT pair_id, attempt, attempt_status FROM attempt_members) GROUP BY pair_id
),
members AS (
  SELECT m.pair_id, m.attempt, benchmark_run_id, architecture, protocol, started_at, finished_at,
         attempt_status, CAST(p.attempts - 1 AS INTEGER) AS retry_count
  FROM attempt_members m JOIN per_pair p ON m.pair_id = p.pair_id AND m.attempt = p.accepted_attempt
  WHERE p.complete_attempts = 1
)"""


def members_of(rm: DataFrame) -> DataFrame:
    return pairing.accepted_members(attempt_members(rm))[0]


register("accepted_attempts", oracle.with_metrics("SELECT * FROM members", ATTEMPTS_SQL))(
    lambda spark, sf: members_of(_rm(spark, sf)))

register("attempt_violations", oracle.with_metrics(
    "SELECT pair_id, 'complete_attempts' AS rule, "
    "format('expected one complete attempt, found {:d}', complete_attempts) AS observed "
    "FROM per_pair WHERE complete_attempts <> 1", ATTEMPTS_SQL))(
    lambda spark, sf: pairing.accepted_members(attempt_members(_rm(spark, sf)))[1])


def arch_pairs(spark, sf) -> DataFrame:
    rm = _rm(spark, sf)
    return pairing.pair_by_architecture(pairing.scoped_metrics(rm, members_of(rm)))


PAIRS_SQL = ATTEMPTS_SQL + """,
scoped AS (
  SELECT r.*, m.pair_id, m.architecture AS arch,
         m.protocol || ':' || CASE
           WHEN r.metric_type = 'pipeline' THEN 'pipeline:' || concat_ws(':', r.dataset, CAST(r.year AS VARCHAR), CAST(r.month AS VARCHAR))
           WHEN r.metric_type = 'trino_query' THEN 'query:' || r.query_name || ':' || concat_ws(':', r.dataset, CAST(r.year AS VARCHAR), CAST(r.month AS VARCHAR))
         END AS key
  FROM run_metrics r JOIN members m ON r.benchmark_run_id = m.benchmark_run_id
),
latest AS (
  SELECT key, pair_id, arch, duration_seconds AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY key, pair_id, arch ORDER BY started_at DESC, metric_id DESC) AS rn
    FROM scoped WHERE key IS NOT NULL AND duration_seconds IS NOT NULL) WHERE rn = 1
),
pairs AS (
  SELECT key, pair_id, max(CASE WHEN arch = 'onprem' THEN v END) AS onprem,
         max(CASE WHEN arch = 'hybrid_aws' THEN v END) AS hybrid_aws
  FROM latest GROUP BY key, pair_id HAVING onprem IS NOT NULL AND hybrid_aws IS NOT NULL
)"""


def _desc_sql(col: str, p: str) -> str:
    q = lambda x: f"quantile_cont({col}, {x})"
    return (f"count({col}) AS {p}n, round({q(0.5)}, 6) AS {p}median, round({q(0.25)}, 6) AS {p}q1, "
            f"round({q(0.75)}, 6) AS {p}q3, round({q(0.75)} - {q(0.25)}, 6) AS {p}iqr, round({q(0.95)}, 6) AS {p}p95")


DESC_COLS = [f"{s}_{c}" for s in ("onprem", "hybrid_aws") for c in ("median", "q1", "q3", "iqr", "p95")]

register("paired_summary", oracle.with_metrics(f"""
SELECT key, {_desc_sql('onprem', 'onprem_')}, {_desc_sql('hybrid_aws', 'hybrid_aws_')},
       round(quantile_cont((hybrid_aws - onprem) / onprem * 100, 0.5), 6) AS median_paired_delta_percent
FROM pairs GROUP BY key""", PAIRS_SQL))(
    lambda spark, sf: rnd(pairing.paired_summary(arch_pairs(spark, sf)),
                          {c: 6 for c in DESC_COLS + ["median_paired_delta_percent"]}))


def bootstrap_sql(src: str, keys: list[str], value: str, order: str, seed: int, resamples: int) -> str:
    """SQL rendering of :func:`tollgate.operators.stats.bootstrap_median`."""
    def scrambled(x: str) -> str:
        for _ in range(2):
            x = f"((xor({x}, {x} >> 16) * 73244475) & 4294967295)"
        return f"xor({x}, {x} >> 16)"

    k = ", ".join(keys)
    kv = ", ".join(f"CAST({x} AS VARCHAR)" for x in keys)
    on = " AND ".join(f"d.{x} = i.{x}" for x in keys + ["i"])
    coins = f"{scrambled('xor((a + j) & 4294967295, (s >> 28) & 4294967295)')} & ((1 << least(m - {stats.COINS} * j, {stats.COINS})) - 1)"
    walk = "b_w"
    for level in range(stats.DIGITS):  # one binary digit of the wanted draw each
        walk = f"""(SELECT {k}, n, r, s, CASE WHEN k < c THEN c ELSE m - c END AS m, CASE WHEN k < c THEN k ELSE k - c END AS k, u * 2 + CASE WHEN k < c THEN 0 ELSE 1 END AS u
  FROM (SELECT *, CAST(list_sum(list_transform(range(0, (m + {stats.COINS - 1}) // {stats.COINS}), lambda j: bit_count({coins}))) AS BIGINT) AS c
  FROM (SELECT *, {scrambled("a0")} AS a FROM (SELECT *, xor(s & 4294967295, (({2 ** level} + u) * 73244475) & 4294967295) AS a0 FROM {walk}))))"""
    return f"""SELECT * FROM (
WITH b_idx AS (
  SELECT {k}, {value} AS v, row_number() OVER (PARTITION BY {k} ORDER BY {value}, {order}) - 1 AS i
  FROM {src} WHERE {value} IS NOT NULL),
b_n AS (SELECT {k}, count(*) AS n, quantile_cont(v, 0.5) AS median FROM b_idx GROUP BY {k}),
b_r AS (SELECT {k}, n, unnest(range(0, {resamples})) AS r FROM b_n),
b_s AS (SELECT *, CAST(concat('0x', substr(md5(concat_ws(':', '{seed}', {kv}, CAST(r AS VARCHAR))), 1, 15)) AS BIGINT) AS s FROM b_r),
b_w AS (SELECT {k}, n, r, s, n AS m, unnest([(n - 1) // 2, n // 2]) AS k, CAST(0 AS BIGINT) AS u FROM b_s),
b_h AS (SELECT {k}, r, ((((u & 65535) * n) >> 16) + (u >> 16) * n) >> 16 AS i FROM {walk}),
b_est AS (SELECT {", ".join("d." + x for x in keys)}, d.r, quantile_cont(i.v, 0.5) AS est
          FROM b_h d JOIN b_idx i ON {on} GROUP BY {", ".join("d." + x for x in keys)}, d.r),
b_ci AS (SELECT {k}, quantile_cont(est, 0.025) AS lo, quantile_cont(est, 0.975) AS hi FROM b_est GROUP BY {k})
SELECT {", ".join("b_n." + x for x in keys)}, b_n.n, round(b_n.median, 6) AS median, round(b_ci.lo, 6) AS ci95_low,
       round(b_ci.hi, 6) AS ci95_high, {seed} AS seed, {resamples} AS resamples
FROM b_n LEFT JOIN b_ci ON {" AND ".join(f"b_n.{x} = b_ci.{x}" for x in keys)})"""


BOOT_ROUND = {"median": 6, "ci95_low": 6, "ci95_high": 6, "median_paired_delta_percent": 6}


@register("paired_bootstrap", oracle.with_metrics(
    "SELECT key, n, median AS median_paired_delta_percent, ci95_low, ci95_high, "
    "CAST(0 AS BIGINT) AS zero_base_pairs, seed, resamples FROM ("
    + bootstrap_sql("(SELECT key, pair_id, (hybrid_aws - onprem) / onprem * 100 AS d FROM pairs WHERE onprem <> 0)",
                    ["key"], "d", "pair_id", SEED, stats.BOOTSTRAP_RESAMPLES) + ")",
    PAIRS_SQL))
def q_paired_bootstrap(spark, sf):
    out = pairing.paired_intervals(arch_pairs(spark, sf))
    return rnd(out, BOOT_ROUND)


@register("median_bootstrap", oracle.with_metrics(
    bootstrap_sql("pairs", ["key"], "onprem", "pair_id", SEED, stats.BOOTSTRAP_RESAMPLES), PAIRS_SQL))
def q_median_bootstrap(spark, sf):
    out = stats.bootstrap_median(arch_pairs(spark, sf), ["key"], "onprem", ["pair_id"])
    return rnd(out, BOOT_ROUND)


# ---------------------------------------------------------------------------
# 2x2 layout effects
# ---------------------------------------------------------------------------

RECORDED = ("warm_recorded", "service_cold_recorded")


def layout_cells(spark, sf) -> DataFrame:
    rm = _rm(spark, sf).where((F.col("metric_type") == "trino_query")
                              & F.col("measurement_protocol").isin(*RECORDED))
    return pairing.assemble_cells(rm, "duration_seconds", pair_col="trial_id")


CELLS_SQL = f"""
sel AS (SELECT * FROM run_metrics WHERE metric_type = 'trino_query'
        AND measurement_protocol IN ('{RECORDED[0]}', '{RECORDED[1]}')),
cl AS (
  SELECT measurement_protocol, query_name, trial_id, architecture, file_layout, duration_seconds AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY measurement_protocol, query_name, trial_id, architecture, file_layout
                                 ORDER BY started_at DESC, metric_id DESC) AS rn FROM sel) WHERE rn = 1
),
cells AS (
  SELECT measurement_protocol, query_name, trial_id,
         max(CASE WHEN architecture = 'onprem' AND file_layout = 'fragmented' THEN v END) AS onprem_fragmented,
         max(CASE WHEN architecture = 'onprem' AND file_layout = 'compact' THEN v END) AS onprem_compact,
         max(CASE WHEN architecture = 'hybrid_aws' AND file_layout = 'fragmented' THEN v END) AS hybrid_aws_fragmented,
         max(CASE WHEN architecture = 'hybrid_aws' AND file_layout = 'compact' THEN v END) AS hybrid_aws_compact
  FROM cl GROUP BY measurement_protocol, query_name, trial_id
),
cells2 AS (
  SELECT *, (onprem_fragmented IS NOT NULL AND onprem_compact IS NOT NULL AND hybrid_aws_fragmented IS NOT NULL
             AND hybrid_aws_compact IS NOT NULL) AS complete FROM cells
),
eff AS (
  SELECT measurement_protocol, query_name, trial_id, effect, value FROM (
    SELECT measurement_protocol, query_name, trial_id,
      unnest(['{pairing.EFFECTS[0]}', '{pairing.EFFECTS[1]}', '{pairing.EFFECTS[2]}', '{pairing.EFFECTS[3]}', '{pairing.EFFECTS[4]}']) AS effect,
      unnest([
        CASE WHEN onprem_compact <> 0 THEN (onprem_fragmented - onprem_compact) / onprem_compact * 100 END,
        CASE WHEN hybrid_aws_compact <> 0 THEN (hybrid_aws_fragmented - hybrid_aws_compact) / hybrid_aws_compact * 100 END,
        CASE WHEN onprem_fragmented <> 0 THEN (hybrid_aws_fragmented - onprem_fragmented) / onprem_fragmented * 100 END,
        CASE WHEN onprem_compact <> 0 THEN (hybrid_aws_compact - onprem_compact) / onprem_compact * 100 END,
        (CASE WHEN hybrid_aws_compact <> 0 THEN (hybrid_aws_fragmented - hybrid_aws_compact) / hybrid_aws_compact * 100 END)
          - (CASE WHEN onprem_compact <> 0 THEN (onprem_fragmented - onprem_compact) / onprem_compact * 100 END)
      ]) AS value
    FROM cells2 WHERE complete) WHERE value IS NOT NULL
)"""

register("layout_cells", oracle.with_metrics(
    "SELECT * FROM cells2", CELLS_SQL))(layout_cells)


@register("layout_effects", oracle.with_metrics(f"""
SELECT b.*, c.complete_pairs, c.missing_pairs FROM (
{bootstrap_sql('eff', ['measurement_protocol', 'query_name', 'effect'], 'value', 'trial_id', SEED, stats.BOOTSTRAP_RESAMPLES)}
) b LEFT JOIN (
  SELECT measurement_protocol, query_name,
         CAST(sum(CASE WHEN complete THEN 1 ELSE 0 END) AS BIGINT) AS complete_pairs,
         CAST(sum(CASE WHEN NOT complete THEN 1 ELSE 0 END) AS BIGINT) AS missing_pairs
  FROM cells2 GROUP BY measurement_protocol, query_name
) c ON b.measurement_protocol = c.measurement_protocol AND b.query_name = c.query_name""", CELLS_SQL))
def q_layout_effects(spark, sf):
    out = pairing.layout_effects(layout_cells(spark, sf), pair_col="trial_id")
    return rnd(out, BOOT_ROUND)


# ---------------------------------------------------------------------------
# partition pruning
# ---------------------------------------------------------------------------

PRUNE_ROUND = {c: 6 for c in (
    "broad_latency_median_seconds", "filtered_latency_median_seconds", "latency_reduction_percent",
    "broad_physical_input_bytes", "filtered_physical_input_bytes", "physical_input_reduction_percent",
    "broad_hybrid_penalty_percent", "filtered_hybrid_penalty_percent",
    "hybrid_penalty_narrowing_percentage_points")}


def pruning_rows(spark, sf) -> DataFrame:
    return pairing.broad_vs_filtered(_rm(spark, sf), FILTERED_QUERY, BROAD_QUERY)


PRUNE_SQL = f"""
psel AS (SELECT * FROM run_metrics WHERE metric_type = 'trino_query'
         AND measurement_protocol IN ('warm_recorded', 'service_cold_recorded')),
pb AS (SELECT measurement_protocol, architecture, dataset, year, count(*) AS n_broad,
              quantile_cont(duration_seconds, 0.5) AS broad_latency_median_seconds,
              quantile_cont(CAST(physical_input_bytes AS DOUBLE), 0.5) AS broad_physical_input_bytes
       FROM psel WHERE query_name = '{BROAD_QUERY}' GROUP BY ALL),
pf AS (SELECT measurement_protocol, architecture, dataset, year, month, count(*) AS n_filtered,
              quantile_cont(duration_seconds, 0.5) AS filtered_latency_median_seconds,
              quantile_cont(CAST(physical_input_bytes AS DOUBLE), 0.5) AS filtered_physical_input_bytes
       FROM psel WHERE query_name = '{FILTERED_QUERY}' GROUP BY ALL),
prows AS (
  SELECT pf.measurement_protocol, pf.architecture, pf.dataset, pf.year, pf.month, n_broad, n_filtered,
         (n_broad = e.n AND n_filtered = e.n) AS n_ok,
         broad_latency_median_seconds, filtered_latency_median_seconds,
         CASE WHEN broad_latency_median_seconds <> 0 THEN (broad_latency_median_seconds - filtered_latency_median_seconds) / broad_latency_median_seconds * 100 END AS latency_reduction_percent,
         broad_physical_input_bytes, filtered_physical_input_bytes,
         CASE WHEN broad_physical_input_bytes <> 0 THEN (broad_physical_input_bytes - filtered_physical_input_bytes) / broad_physical_input_bytes * 100 END AS physical_input_reduction_percent
  FROM pf JOIN pb USING (measurement_protocol, architecture, dataset, year)
  JOIN (VALUES ('warm_recorded', 5), ('service_cold_recorded', 3)) e(p, n) ON e.p = pf.measurement_protocol
),
ppen AS (
  SELECT measurement_protocol, dataset, year, month,
         (bb - ab) / ab * 100 AS broad_hybrid_penalty_percent,
         (bf - af) / af * 100 AS filtered_hybrid_penalty_percent,
         (bb - ab) / ab * 100 - (bf - af) / af * 100 AS hybrid_penalty_narrowing_percentage_points
  FROM (SELECT measurement_protocol, dataset, year, month,
               max(CASE WHEN architecture = 'onprem' THEN broad_latency_median_seconds END) AS ab,
               max(CASE WHEN architecture = 'hybrid_aws' THEN broad_latency_median_seconds END) AS bb,
               max(CASE WHEN architecture = 'onprem' THEN filtered_latency_median_seconds END) AS af,
               max(CASE WHEN architecture = 'hybrid_aws' THEN filtered_latency_median_seconds END) AS bf
        FROM prows GROUP BY ALL)
  WHERE ab IS NOT NULL AND bb IS NOT NULL AND af IS NOT NULL AND bf IS NOT NULL
)"""


def _round_all(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


register("pruning_effects", oracle.with_metrics(
    "SELECT measurement_protocol, architecture, dataset, year, month, n_broad, n_filtered, n_ok, "
    + _round_all(["broad_latency_median_seconds", "filtered_latency_median_seconds", "latency_reduction_percent",
                  "broad_physical_input_bytes", "filtered_physical_input_bytes", "physical_input_reduction_percent"])
    + " FROM prows", PRUNE_SQL))(lambda spark, sf: rnd(pruning_rows(spark, sf), PRUNE_ROUND))

register("penalty_narrowing", oracle.with_metrics(
    "SELECT measurement_protocol, dataset, year, month, "
    + _round_all(["broad_hybrid_penalty_percent", "filtered_hybrid_penalty_percent",
                  "hybrid_penalty_narrowing_percentage_points"]) + " FROM ppen", PRUNE_SQL))(
    lambda spark, sf: rnd(pairing.penalty_narrowing(pruning_rows(spark, sf)), PRUNE_ROUND))

FINDINGS_COLS = ["input_reduction_min", "input_reduction_median", "input_reduction_max",
                 "latency_reduction_min", "latency_reduction_median", "latency_reduction_max",
                 "narrowing_min", "narrowing_median", "narrowing_max"]


@register("pruning_findings", oracle.with_metrics("""
SELECT round(min(physical_input_reduction_percent), 6) AS input_reduction_min,
       round(quantile_cont(physical_input_reduction_percent, 0.5), 6) AS input_reduction_median,
       round(max(physical_input_reduction_percent), 6) AS input_reduction_max,
       round(min(latency_reduction_percent), 6) AS latency_reduction_min,
       round(quantile_cont(latency_reduction_percent, 0.5), 6) AS latency_reduction_median,
       round(max(latency_reduction_percent), 6) AS latency_reduction_max,
       CAST(sum(CASE WHEN latency_reduction_percent > 0 THEN 1 ELSE 0 END) AS BIGINT) AS latency_improved_cases,
       count(*) AS latency_case_count,
       CAST(sum(CASE WHEN architecture = 'hybrid_aws' AND latency_reduction_percent > 0 THEN 1 ELSE 0 END) AS BIGINT) AS hybrid_latency_improved_cases,
       CAST(sum(CASE WHEN architecture = 'hybrid_aws' THEN 1 ELSE 0 END) AS BIGINT) AS hybrid_latency_case_count,
       (SELECT round(min(hybrid_penalty_narrowing_percentage_points), 6) FROM ppen) AS narrowing_min,
       (SELECT round(quantile_cont(hybrid_penalty_narrowing_percentage_points, 0.5), 6) FROM ppen) AS narrowing_median,
       (SELECT round(max(hybrid_penalty_narrowing_percentage_points), 6) FROM ppen) AS narrowing_max,
       (SELECT CAST(sum(CASE WHEN hybrid_penalty_narrowing_percentage_points > 0 THEN 1 ELSE 0 END) AS BIGINT) FROM ppen) AS hybrid_penalty_narrowed_cases,
       (SELECT count(*) FROM ppen) AS hybrid_penalty_case_count
FROM prows""", PRUNE_SQL))
def q_pruning_findings(spark, sf):
    rows = pruning_rows(spark, sf)
    return rnd(pairing.pruning_findings(rows, pairing.penalty_narrowing(rows)), {c: 6 for c in FINDINGS_COLS})
