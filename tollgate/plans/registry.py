"""Registered queries: name -> (Spark callable, oracle SQL).

Every callable takes ``(spark, sf_dir)`` and runs over the whole derived
tables.  Output doubles are rounded the way the reference's own
cross-engine correctness check rounds them (money sums 2 dp, averages and
ratios 6 dp) so that summation order cannot flip a value hash.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import marts, normalize, quality
from tollgate.plans import oracle
from tollgate.plans.datasets import silver, silver_all
from tollgate.session import checkpoint_root, pin
from tollgate.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the session's time zone is pinned first
    (timestamps, year/month extraction and ISO rendering depend on it)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin(spark)
            return fn(spark, sf_dir)
        run.__name__ = getattr(fn, "__name__", name)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rnd(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items() if c in df.columns})


PKEYS = "dataset, year, month"

# ---------------------------------------------------------------------------
# Silver (P1-P13)
# ---------------------------------------------------------------------------

register("silver_yellow", oracle.with_silver("SELECT * FROM silver_yellow"))(
    lambda spark, sf: silver(spark, sf, "yellow"))
register("silver_green", oracle.with_silver("SELECT * FROM silver_green"))(
    lambda spark, sf: silver(spark, sf, "green"))


@register("money_decimal", oracle.with_silver(
    "SELECT dataset, year, month, pickup_location_id, "
    + ", ".join(f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in ("fare_amount", "tip_amount", "tolls_amount", "total_amount"))
    + " FROM silver_all"))
def q_money_decimal(spark, sf):
    df = silver_all(spark, sf).select(PKEYS.split(", ") + ["pickup_location_id", "fare_amount", "tip_amount", "tolls_amount", "total_amount"])
    return normalize.money_to_decimal(df)


# ---------------------------------------------------------------------------
# Gold (A4) and the SQL suite
# ---------------------------------------------------------------------------

_REV = "(is_valid_trip = true AND fare_amount > 0 AND total_amount > 0)"


def _rev(col: str) -> str:
    return f"CASE WHEN {_REV} THEN CAST({col} AS DOUBLE) END"


GOLD_SQL = oracle.with_silver(f"""
SELECT dataset, year, month, count(*) AS trip_count,
       CAST(sum(CASE WHEN is_valid_trip = true THEN 1 ELSE 0 END) AS BIGINT) AS valid_trip_count,
       CAST(sum(CASE WHEN {_REV} THEN 1 ELSE 0 END) AS BIGINT) AS revenue_trip_count,
       round(coalesce(sum({_rev('fare_amount')}), 0.0), 2) AS fare_amount_sum,
       round(coalesce(sum({_rev('tip_amount')}), 0.0), 2) AS tip_amount_sum,
       round(coalesce(sum({_rev('tolls_amount')}), 0.0), 2) AS tolls_amount_sum,
       round(coalesce(sum({_rev('total_amount')}), 0.0), 2) AS total_amount_sum,
       round(avg({_rev('fare_amount')}), 6) AS avg_fare_amount,
       round(avg({_rev('tip_amount')}), 6) AS avg_tip_amount,
       round(avg({_rev('trip_distance')}), 6) AS avg_trip_distance,
       round(avg({_rev('trip_duration_min')}), 6) AS avg_trip_duration_min
FROM silver_all GROUP BY dataset, year, month""")

GOLD_ROUND = {
    "fare_amount_sum": 2, "tip_amount_sum": 2, "tolls_amount_sum": 2, "total_amount_sum": 2,
    "avg_fare_amount": 6, "avg_tip_amount": 6, "avg_trip_distance": 6, "avg_trip_duration_min": 6,
}


@register("gold_revenue_monthly", GOLD_SQL)
def q_gold(spark, sf):
    return rnd(marts.monthly_revenue(silver_all(spark, sf)).drop("processed_at"), GOLD_ROUND)


@register("gold_revenue_check", oracle.with_silver(f"""
SELECT dataset, year, month, count(*) AS trip_count,
       CAST(sum(CASE WHEN is_valid_trip = true THEN 1 ELSE 0 END) AS BIGINT) AS valid_trip_count,
       CAST(sum(CASE WHEN {_REV} THEN 1 ELSE 0 END) AS BIGINT) AS revenue_trip_count,
       round(coalesce(sum({_rev('total_amount')}), 0.0), 2) AS total_amount_sum,
       round(avg({_rev('trip_distance')}), 6) AS avg_trip_distance,
       round(avg({_rev('trip_duration_min')}), 6) AS avg_trip_duration_min
FROM silver_all GROUP BY dataset, year, month"""))
def q_gold_check(spark, sf):
    gold = marts.monthly_revenue(silver_all(spark, sf))
    return rnd(gold.select("dataset", "year", "month", "trip_count", "valid_trip_count",
                           "revenue_trip_count", "total_amount_sum", "avg_trip_distance",
                           "avg_trip_duration_min"), GOLD_ROUND)


register("partition_row_count", oracle.with_silver(
    f"SELECT {PKEYS}, count(*) AS row_count FROM silver_all GROUP BY {PKEYS}"))(
    lambda spark, sf: marts.row_count(silver_all(spark, sf)))

FIN_ROUND = {"total_amount": 2, "avg_trip_distance": 6, "avg_trip_duration_min": 6}
_FIN = ("round(sum(total_amount), 2) AS total_amount, round(avg(trip_distance), 6) AS avg_trip_distance, "
        "round(avg(trip_duration_min), 6) AS avg_trip_duration_min")

register("partition_financial", oracle.with_silver(
    f"SELECT {PKEYS}, {_FIN} FROM silver_all GROUP BY {PKEYS}"))(
    lambda spark, sf: rnd(marts.financial_aggregate(silver_all(spark, sf)), FIN_ROUND))

register("dataset_financial_scan", oracle.with_silver(
    f"SELECT dataset, {_FIN} FROM silver_all GROUP BY dataset"))(
    lambda spark, sf: rnd(marts.financial_aggregate(silver_all(spark, sf), by=["dataset"]), FIN_ROUND))

register("pickup_location", oracle.with_silver(
    f"SELECT {PKEYS}, pickup_location_id, count(*) AS trip_count, round(sum(total_amount), 2) AS total_amount "
    f"FROM silver_all GROUP BY {PKEYS}, pickup_location_id"))(
    lambda spark, sf: rnd(marts.pickup_aggregate(silver_all(spark, sf)), {"total_amount": 2}))

register("trips_by_year", oracle.with_silver(
    "SELECT dataset, year, count(*) AS trip_count FROM silver_all GROUP BY dataset, year ORDER BY dataset, year"))(
    lambda spark, sf: marts.trips_by_period(silver_all(spark, sf), by=["year"]))

register("trips_by_month", oracle.with_silver(
    f"SELECT {PKEYS}, count(*) AS trip_count FROM silver_all GROUP BY {PKEYS} ORDER BY {PKEYS}"))(
    lambda spark, sf: marts.trips_by_period(silver_all(spark, sf), by=["year", "month"]))

register("deterministic_partition", oracle.with_silver(f"""
SELECT {PKEYS}, count(*) AS row_count,
       CAST(sum(CASE WHEN is_valid_trip THEN 1 ELSE 0 END) AS BIGINT) AS valid_trip_count,
       count(DISTINCT pickup_location_id) AS pickup_location_count,
       CAST(round(sum(CAST(total_amount AS DECIMAL(38,6))), 4) AS VARCHAR) AS total_amount_sum
FROM silver_all GROUP BY {PKEYS}"""))(
    lambda spark, sf: marts.deterministic_results(silver_all(spark, sf)))

register("deterministic_pickup", oracle.with_silver(f"""
SELECT {PKEYS}, pickup_location_id, count(*) AS trip_count,
       CAST(round(sum(CAST(total_amount AS DECIMAL(38,6))), 4) AS VARCHAR) AS total_amount_sum
FROM silver_all GROUP BY {PKEYS}, pickup_location_id ORDER BY {PKEYS}, pickup_location_id"""))(
    lambda spark, sf: marts.deterministic_pickup(silver_all(spark, sf)))


# ---------------------------------------------------------------------------
# Quality (A2, A3, V5, V6, A8, W1)
# ---------------------------------------------------------------------------

register("validity_mismatch", oracle.with_silver(f"""
SELECT {PKEYS}, CAST(sum(CASE WHEN is_valid_trip IS NULL OR is_valid_trip <> (trip_duration_min > 0)
                         THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_count
FROM silver_all GROUP BY {PKEYS}"""))(
    lambda spark, sf: quality.validity_mismatches(silver_all(spark, sf), by=["dataset", "year", "month"]))

register("signed_corrections", oracle.with_silver(f"""
SELECT {PKEYS},
       CAST(sum(CASE WHEN tip_amount < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_tip_amount_rows,
       CAST(sum(CASE WHEN tolls_amount < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_tolls_amount_rows
FROM silver_all GROUP BY {PKEYS}"""))(
    lambda spark, sf: quality.signed_corrections(silver_all(spark, sf), by=["dataset", "year", "month"]))


@register("dry_run_counters", oracle.with_silver("""
SELECT dataset, counter, n FROM (
  SELECT dataset, count(*) AS "rows",
         count(*) FILTER (WHERE is_valid_trip IS NULL OR is_valid_trip <> (trip_duration_min > 0)) AS validity_mismatch,
         count(*) FILTER (WHERE tip_amount < 0) AS negative_tip, count(*) FILTER (WHERE tolls_amount < 0) AS negative_tolls
  FROM silver_all GROUP BY dataset)
UNPIVOT (n FOR counter IN ("rows", validity_mismatch, negative_tip, negative_tolls))"""))
def q_dry_run_counters(spark, sf):
    counters = {
        "validity_mismatch": F.count_if(F.col("is_valid_trip").isNull() | (F.col("is_valid_trip") != (F.col("trip_duration_min") > 0))),
        "negative_tip": F.count_if(F.col("tip_amount") < 0),
        "negative_tolls": F.count_if(F.col("tolls_amount") < 0),
    }
    rows = [(ds, name, n) for ds in ("yellow", "green")
            for name, n in tables.rehearse(silver(spark, sf, ds), counters).counters.items()]
    return spark.createDataFrame(rows, "dataset string, counter string, n long")


def _count_if_sql(pred: str) -> str:
    return f"CAST(sum(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


def _rule_rows_sql(dataset: str, rules: list[quality.Rule]) -> str:
    counts = ", ".join(f"{_count_if_sql(r.sql_violation())} AS r{i}" for i, r in enumerate(rules))
    unions = " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, year, month, '{r.name}' AS rule, '{r.category}' AS category, r{i} AS violations FROM c"
        for i, r in enumerate(rules)
    )
    return f"SELECT * FROM (WITH c AS (SELECT year, month, {counts} FROM silver_{dataset} GROUP BY year, month) {unions})"


@register("row_rules", oracle.with_silver(
    _rule_rows_sql("yellow", quality.silver_rules("yellow")) + " UNION ALL "
    + _rule_rows_sql("green", quality.silver_rules("green"))))
def q_row_rules(spark, sf):
    out = []
    for ds in ("yellow", "green"):
        long = quality.rule_violations_long(silver(spark, sf, ds), quality.silver_rules(ds), ["year", "month"])
        out.append(long.select(F.lit(ds).alias("dataset"), "*"))
    return out[0].unionByName(out[1])


def audit_sql(dataset: str, rules: list[quality.Rule], ctx: dict, detail: bool = False,
              keep_processed_at: bool = False) -> str:
    """Oracle text of :func:`tollgate.operators.quality.audit` for one dataset."""
    c = f"c_{dataset}"
    mismatch = "is_valid_trip IS NULL OR is_valid_trip <> (trip_duration_min > 0)"
    counts = ", ".join([
        "count(*) AS n", f"{_count_if_sql(mismatch)} AS mismatch",
        f"{_count_if_sql('tip_amount < 0')} AS neg_tip", f"{_count_if_sql('tolls_amount < 0')} AS neg_tolls",
    ] + [f"{_count_if_sql(r.sql_violation())} AS r{i}" for i, r in enumerate(rules)])
    schema_fail = " OR ".join([f"r{i} > 0" for i, r in enumerate(rules) if r.category == "SCHEMA"]) or "false"
    data_fail = " OR ".join([f"r{i} > 0" for i, r in enumerate(rules) if r.category == "DATA"]) or "false"
    ng = f"((CASE WHEN {schema_fail} THEN 1 ELSE 0 END) + (CASE WHEN {data_fail} THEN 1 ELSE 0 END))"
    entries = ", ".join(
        f"CASE WHEN r{i} > 0 THEN '\"{r.category}:{r.name}\":' || CAST(r{i} AS VARCHAR) END"
        for i, r in enumerate(rules)
    )
    extra = f"CASE WHEN {ng} > 0 THEN '{{' || concat_ws(',', {entries}) || '}}' END"
    pf = lambda ok: f"CASE WHEN {ok} THEN 'pass' ELSE 'fail' END"
    warn = lambda col: f"CASE WHEN {col} > 0 THEN 'warn' ELSE 'pass' END"
    rows = [
        (1, quality.ROW_COUNT_CHECK[0], "hard", pf("n > 0"), "n", quality.ROW_COUNT_CHECK[2], "NULL"),
        (2, quality.DERIVATION_CHECK[0], "hard", pf("mismatch = 0"), "mismatch", quality.DERIVATION_CHECK[2], "NULL"),
        (3, quality.SIGNED_CHECKS[0], "soft", warn("neg_tip"), "neg_tip", quality.SIGNED_THRESHOLD, f"'{quality.SIGNED_EXTRA}'"),
        (3, quality.SIGNED_CHECKS[1], "soft", warn("neg_tolls"), "neg_tolls", quality.SIGNED_THRESHOLD, f"'{quality.SIGNED_EXTRA}'"),
        (4, quality.RULES_CHECK[0], "hard", pf(f"{ng} = 0"), ng, quality.RULES_CHECK[2], extra),
    ]
    if detail:
        rows += [(5, f"rule:{r.name}", "hard", pf(f"r{i} = 0"), f"r{i}", "0 violations", "NULL")
                 for i, r in enumerate(rules)]
    checks = " UNION ALL ".join(
        f"SELECT year, month, {st} AS stage, '{name}' AS check_name, '{sev}' AS severity, {status} AS status, "
        f"CAST({obs} AS VARCHAR) AS observed_value, '{thr}' AS threshold, CAST({ex} AS VARCHAR) AS extra FROM {c}"
        for st, name, sev, status, obs, thr, ex in rows
    )
    lit = lambda v: "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    proc = f", TIMESTAMP '{ctx['processed_at']}' AS processed_at" if keep_processed_at else ""
    return f"""SELECT * FROM (WITH {c} AS (SELECT year, month, {counts} FROM silver_{dataset} GROUP BY year, month),
ch AS ({checks}),
ff AS (SELECT year, month, min(stage) AS first_fail FROM ch WHERE severity = 'hard' AND status = 'fail' GROUP BY year, month)
SELECT CAST({lit(ctx.get('benchmark_run_id'))} AS VARCHAR) AS benchmark_run_id,
       CAST({lit(ctx.get('dag_run_id'))} AS VARCHAR) AS dag_run_id,
       CAST({lit(ctx.get('repetition'))} AS INTEGER) AS repetition,
       '{dataset}' AS dataset, ch.year, ch.month, check_name, severity, status, observed_value, threshold, extra{proc}
FROM ch LEFT JOIN ff ON ch.year = ff.year AND ch.month = ff.month
WHERE ff.first_fail IS NULL OR least(ch.stage, 4) <= ff.first_fail)"""


# Audit runs used by the audit queries: (context, min_year, detail).
ADAPTER_MIN_YEAR = 1995
AUDIT_RUNS = [
    ({"benchmark_run_id": "bench-1", "dag_run_id": "dag-a", "repetition": 1,
      "processed_at": "2024-01-01 00:00:00"}, ADAPTER_MIN_YEAR, False),
    ({"benchmark_run_id": "bench-2", "dag_run_id": "dag-b", "repetition": 2,
      "processed_at": "2024-01-02 00:00:00"}, None, True),
    ({"benchmark_run_id": "bench-2", "dag_run_id": "dag-c", "repetition": 3,
      "processed_at": "2024-01-02 00:00:00"}, ADAPTER_MIN_YEAR, False),
]


def _audit_frames(spark, sf, runs=AUDIT_RUNS) -> DataFrame:
    frames = []
    checkpoint_root(spark)
    for ds in ("yellow", "green"):
        # Audited by several runs: materialize silver once (shared folder).
        df = silver(spark, sf, ds).checkpoint(eager=True)
        for ctx, min_year, detail in runs:
            c = dict(ctx)
            c["processed_at"] = F.lit(dt.datetime.fromisoformat(ctx["processed_at"]))
            frames.append(quality.audit(df, ds, rules=quality.silver_rules(ds, min_year), context=c, detail=detail))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _audit_sql_all(runs=AUDIT_RUNS, keep_processed_at=False) -> str:
    parts = []
    for ds in ("yellow", "green"):
        for ctx, min_year, detail in runs:
            parts.append(audit_sql(ds, quality.silver_rules(ds, min_year), ctx, detail, keep_processed_at))
    return " UNION ALL ".join(parts)


register("audit_gated", oracle.with_silver(_audit_sql_all(AUDIT_RUNS[:1])))(
    lambda spark, sf: _audit_frames(spark, sf, AUDIT_RUNS[:1]).drop("processed_at"))

register("quality_status_by_run", oracle.with_silver(f"""
SELECT benchmark_run_id, {PKEYS}, status, count(*) AS check_count
FROM ({_audit_sql_all()}) GROUP BY benchmark_run_id, {PKEYS}, status
ORDER BY benchmark_run_id, {PKEYS}, status"""))(
    lambda spark, sf: marts.status_summary(_audit_frames(spark, sf), by=["benchmark_run_id", "dataset", "year", "month"]))

register("quality_status_latest", oracle.with_silver(f"""
SELECT {PKEYS}, status, count(*) AS check_count FROM (
  SELECT {PKEYS}, status, row_number() OVER (PARTITION BY {PKEYS}, check_name
                                             ORDER BY processed_at DESC, dag_run_id DESC) AS rn
  FROM ({_audit_sql_all(keep_processed_at=True)})
) WHERE rn = 1 GROUP BY {PKEYS}, status ORDER BY {PKEYS}, status"""))(
    lambda spark, sf: marts.latest_status_summary(_audit_frames(spark, sf)))


def _load_all() -> None:
    # Importing the other registry modules registers their queries.
    from tollgate.plans import (registry_evidence, registry_metrics, registry_reports, registry_tables,  # noqa: F401
                                registry_validation)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(SQL)
