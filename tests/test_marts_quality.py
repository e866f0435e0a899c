import datetime as dt

from pyspark.sql import functions as F

from tollgate.operators import marts, quality
from tests.test_normalize import T0, raw_green, raw_yellow, row
from tollgate.operators.normalize import normalize


def silver(spark, rows, ds="yellow"):
    return normalize((raw_yellow if ds == "yellow" else raw_green)(spark, rows), ds)


def test_gold_no_revenue_partition(spark):
    df = silver(spark, [row(T0, T0 - dt.timedelta(minutes=1))])  # invalid only
    g = marts.monthly_revenue(df, "yellow").first()
    assert g.trip_count == 1 and g.valid_trip_count == 0 and g.revenue_trip_count == 0
    assert g.fare_amount_sum == 0.0 and g.avg_fare_amount is None


def test_gold_grouped(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=10), fare=10.0, tip=1.0),
            row(T0, T0 + dt.timedelta(minutes=20), fare=20.0, tip=0.0),
            row(T0, T0 + dt.timedelta(minutes=5), fare=-5.0, tip=0.0)]
    g = marts.monthly_revenue(silver(spark, rows), "yellow").first()
    assert g.revenue_trip_count == 2
    assert g.fare_amount_sum == 30.0
    assert abs(g.avg_trip_duration_min - 15.0) < 1e-9


def test_percentile_linear(spark):
    from tollgate.operators.stats import descriptive
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    d = descriptive(df, [], "v").first()
    assert d.q1 == 1.75 and d.median == 2.5 and d.n == 4


def audit_rows(spark, rows, ds="yellow", **kw):
    return quality.audit(silver(spark, rows, ds), ds, context={"dag_run_id": "d"}, **kw).collect()


def test_audit_passes_and_orders(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=3))]
    out = audit_rows(spark, rows)
    names = [r.check_name for r in out]
    assert names == ["partition_row_count", "is_valid_trip_derivation", "negative_tip_amount_rows",
                     "negative_tolls_amount_rows", "pandera_validation"]
    assert all(r.status == "pass" for r in out)


def test_audit_signed_corrections_warn(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=3), fare=-10.0, tip=-1.0, tolls=-2.0)]
    out = {r.check_name: r for r in audit_rows(spark, rows)}
    assert out["negative_tip_amount_rows"].status == "warn"
    assert out["negative_tip_amount_rows"].observed_value == "1"
    assert out["negative_tolls_amount_rows"].severity == "soft"


def test_audit_rule_failure_and_detail(spark):
    bad = [(0, T0, T0 + dt.timedelta(minutes=3), 1, 1.5, 1, "X", 0, 20, 1, 10.0, 1.0, 0.0, 11.0)]
    out = {r.check_name: r for r in audit_rows(spark, bad, detail=True)}
    assert out["pandera_validation"].status == "fail"
    assert out["pandera_validation"].observed_value == "1"  # DATA group only
    assert '"DATA:vendor_id:isin:1,2":1' in out["pandera_validation"].extra
    assert out["rule:store_and_fwd_flag:isin:Y,N"].observed_value == "1"


def test_audit_gating_stops_after_first_hard_failure(spark):
    df = silver(spark, [row(T0, T0 + dt.timedelta(minutes=3))])
    # corrupt the derived flag -> V2 fails, V3/V4 rows are not emitted
    df = df.withColumn("is_valid_trip", F.lit(False))
    out = quality.audit(df, "yellow").collect()
    assert [r.check_name for r in out] == ["partition_row_count", "is_valid_trip_derivation"]
    assert out[1].status == "fail"


def test_audit_empty_requested_partition_fails(spark):
    df = silver(spark, [row(T0, T0 + dt.timedelta(minutes=3))])
    parts = spark.createDataFrame([(2014, 1), (2014, 2)], "year int, month int")
    out = quality.audit(df, "yellow", parts=parts).where("month = 2").collect()
    assert [(r.check_name, r.status, r.observed_value) for r in out] == [("partition_row_count", "fail", "0")]


def test_null_passes_value_rules_but_not_nullability(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=3), flag=None)]
    long = quality.rule_violations_long(silver(spark, rows), quality.silver_rules("yellow"), ["year"])
    got = {r.rule: r.violations for r in long.collect()}
    assert got["store_and_fwd_flag:isin:Y,N"] == 0


def test_latest_status_tie_broken_by_dag_run(spark):
    ts = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame([
        ("r", "dag-a", 1, "yellow", 2014, 1, "c1", "hard", "pass", "1", "", None, ts),
        ("r", "dag-b", 1, "yellow", 2014, 1, "c1", "hard", "fail", "1", "", None, ts),
        ("r", "dag-a", 1, "yellow", 2014, 1, "c2", "hard", "fail", "1", "", None, ts),
        ("r", "dag-c", 1, "yellow", 2014, 1, "c2", "hard", "pass", "1", "", None, ts + dt.timedelta(1)),
    ], quality.QUALITY_RESULTS)
    out = {(r.status): r.check_count for r in marts.latest_status_summary(audit).collect()}
    assert out == {"fail": 1, "pass": 1}


def test_status_summary_counts_all_rows(spark):
    ts = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame([
        ("r1", "d", 1, "yellow", 2014, 1, "c1", "hard", "pass", "1", "", None, ts),
        ("r1", "d", 1, "yellow", 2014, 1, "c1", "hard", "pass", "1", "", None, ts),
        ("r2", "d", 1, "yellow", 2014, 1, "c1", "hard", "fail", "1", "", None, ts),
    ], quality.QUALITY_RESULTS)
    out = marts.status_summary(audit, benchmark_run_id="r1").collect()
    assert [(r.status, r.check_count) for r in out] == [("pass", 2)]


def test_audit_job_sees_real_schema(spark, tmp_path):
    from tollgate.plans.jobs import audit_silver
    df = silver(spark, [row(T0, T0 + dt.timedelta(minutes=3))]).withColumn("passenger_count", F.col("passenger_count").cast("double"))
    path = str(tmp_path / "silver")
    df.write.partitionBy("year", "month").parquet(path)
    rows, failed = audit_silver(spark, "yellow", path, None, context={"dag_run_id": "d"})
    r = {x.check_name: x for x in rows.collect()}
    assert failed and r["pandera_validation"].status == "fail"
    assert "SCHEMA:passenger_count:dtype" in r["pandera_validation"].extra
