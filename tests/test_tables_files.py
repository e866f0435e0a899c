import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tollgate.operators import marts
from tollgate.schemas import GOLD_PARTITION_COLUMNS, RUN_METRICS
from tollgate.sources import files, layout, tables
from tollgate.streaming import ingest
from tests.test_normalize import T0, raw_green, row


def gold_rows(spark):
    return spark.createDataFrame([("yellow", 2011, 1, 10), ("yellow", 2011, 2, 20), ("green", 2014, 1, 30)],
                                 "dataset string, year int, month int, trip_count bigint")


def test_overwrite_partitions_only_present(spark, tmp_table):
    g = gold_rows(spark)
    tables.overwrite_partitions(g, tmp_table, GOLD_PARTITION_COLUMNS)
    tables.overwrite_partitions(g.where("month = 2").withColumn("trip_count", F.lit(99).cast("bigint")),
                                tmp_table, GOLD_PARTITION_COLUMNS)
    tables.overwrite_partitions(g.where("false"), tmp_table, GOLD_PARTITION_COLUMNS)  # zero rows: no-op
    got = sorted((r.dataset, r.month, r.trip_count) for r in tables.read_table(spark, tmp_table).collect())
    assert got == [("green", 1, 30), ("yellow", 1, 10), ("yellow", 2, 99)]
    tables.overwrite_partitions(g.where("false"), tmp_table, GOLD_PARTITION_COLUMNS,
                                clear_empty=[("green", 2014, 1)])
    assert tables.read_table(spark, tmp_table).count() == 2


def test_append_rows_keeps_history(spark, tmp_table):
    g = gold_rows(spark)
    tables.append_rows(g, tmp_table, GOLD_PARTITION_COLUMNS)
    tables.append_rows(g, tmp_table, GOLD_PARTITION_COLUMNS)
    assert tables.read_table(spark, tmp_table).count() == 6


def test_replace_by_key_two_reloads(spark, tmp_table):
    existing = spark.createDataFrame([("m1", 1.0), ("m2", 2.0)], "metric_id string, v double")
    new = spark.createDataFrame([("m2", 20.0), ("m3", 30.0)], "metric_id string, v double")
    tables.overwrite_partitions(existing, tmp_table, [])
    for _ in range(2):
        content = tables.replace_by_key(tables.read_table(spark, tmp_table), new, "metric_id").checkpoint(eager=True)
        content.write.mode("overwrite").parquet(tmp_table)
    got = sorted((r.metric_id, r.v) for r in tables.read_table(spark, tmp_table).collect())
    assert got == [("m1", 1.0), ("m2", 20.0), ("m3", 30.0)]


def test_evolve_schema_path_and_catalog(spark, tmp_table):
    old = spark.createDataFrame([("r1", "c1")], "benchmark_run_id string, comparison_id string")
    old.write.mode("overwrite").parquet(tmp_table)
    added = tables.evolve_schema(spark, tmp_table, RUN_METRICS)
    assert len(added) == len(RUN_METRICS.fields) - 2
    out = tables.read_evolved(spark, tmp_table, RUN_METRICS)
    assert out.columns == [f.name for f in RUN_METRICS.fields] and out.first().metric_id is None
    spark.sql("DROP TABLE IF EXISTS tg_test.evolve")
    tables.create_table(spark, "tg_test.evolve", old.schema)
    assert tables.evolve_schema(spark, "tg_test.evolve", RUN_METRICS)
    assert set(spark.table("tg_test.evolve").columns) == {f.name for f in RUN_METRICS.fields}
    assert "tg_test" in [r[0] for r in tables.list_namespaces(spark).collect()]
    spark.sql("DROP TABLE IF EXISTS tg_test.evolve")


def test_rehearsal_runs_the_plan_and_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (-2, None)], "x long, y string")
    out = tables.rehearse(df, {"negative": F.count_if(F.col("x") < 0), "most": F.max("x")})
    assert out.counters == {"rows": 2, "negative": 1, "most": 1} and out.schema == df.schema and "Physical Plan" in out.plan
    assert tables.rehearse(df.limit(0), {"most": F.max("x")}).counters == {"rows": 0, "most": None}
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.rehearse(df.selectExpr("x div (x - 1) AS z"), {})
    assert not list(tmp_path.iterdir())


def test_dry_run_schema_only(spark):
    df = gold_rows(spark).withColumn("x", F.col("trip_count") * 2)
    assert tables.dry_run(df)["x"].dataType.simpleString() == "bigint"


def test_rewrite_layout_exact_files(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 2).cast("int").alias("month"), F.col("id").alias("v"))
    for kind, expected in (("fragmented", 16), ("compact", 1)):
        target = str(tmp_path / kind)
        layout.rewrite_layout(df, target, ["month"], kind, n_files=16)
        inv = {r.month: (r.file_count, r.empty_files, r.record_count)
               for r in layout.file_inventory(spark, target, ["month"]).collect()}
        assert inv == {"0": (expected, 0, 200), "1": (expected, 0, 200)}
    totals = layout.layout_totals(layout.file_inventory(spark, str(tmp_path / "compact"), ["month"])).first()
    assert (totals.record_count, totals.file_count) == (400, 2)


def test_rewrite_layout_errors(spark, tmp_path):
    df = spark.range(10).select(F.lit(1).alias("month"), F.col("id"))
    with pytest.raises(layout.LayoutError):
        layout.rewrite_layout(df, str(tmp_path / "a"), ["month"], "fragmented", n_files=1)
    with pytest.raises(layout.LayoutError):
        layout.rewrite_layout(df, str(tmp_path / "a"), ["month"], "fragmented", n_files=16)
    with pytest.raises(layout.LayoutError):
        layout.rewrite_layout(df.where("false"), str(tmp_path / "a"), ["month"], "compact")
    with pytest.raises(layout.LayoutError):
        layout.rewrite_layout(df, str(tmp_path / "a"), ["month"], "compact", source=str(tmp_path / "a"))


def test_checksum_mismatch_detected(spark, tmp_path):
    d = tmp_path / "objs"
    d.mkdir()
    (d / "a.parquet").write_bytes(b"abc")
    (d / "b.parquet").write_bytes(b"hello")
    recorded = files.relative(files.checksum_manifest(spark, str(d)), str(d)).checkpoint(eager=True)
    (d / "b.parquet").write_bytes(b"hellO")
    (d / "c.parquet").write_bytes(b"new")
    observed = files.relative(files.checksum_manifest(spark, str(d)), str(d))
    got = sorted((r.key, r.mismatch) for r in files.compare_manifests(recorded, observed).collect())
    assert got == [("b.parquet", "digest_mismatch"), ("c.parquet", "unexpected_observed")]


def test_scan_month_files_with_drift(spark, tmp_path):
    base = str(tmp_path / "raw")
    jan = raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=2))])
    feb = jan.withColumnRenamed("RatecodeID", "RateCodeID").withColumn(
        "lpep_pickup_datetime", F.lit(dt.datetime(2014, 2, 3)).cast("timestamp_ntz"))
    for df, m in ((jan, 1), (feb, 2)):
        df.coalesce(1).write.mode("overwrite").parquet(files.month_paths(base, "green", [(2014, m)])[0])
    raw = files.scan_month_files(spark, base, "green", [(2014, 1), (2014, 2), (2014, 3)])
    from tollgate.operators.normalize import normalize
    out = normalize(raw, "green").select("year", "month", "rate_code_id").collect()
    assert sorted((r.month, r.rate_code_id) for r in out) == [(1, 1), (2, 1)]
    assert files.scan_glob(spark, base, "*.parquet").count() == 2


def test_export_sorted_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "z int, a string")
    files.export(df, str(tmp_path / "csv"), "csv")
    text = "".join(open(os.path.join(tmp_path / "csv", f)).read()
                   for f in os.listdir(tmp_path / "csv") if f.endswith(".csv"))
    assert text.splitlines()[0] == "a,z"


def test_read_run_artifacts(spark, tmp_path):
    art = {"benchmark_run_id": "r1", "error": None,
           "metrics": [{"metric_id": "m1", "metric_type": "pipeline"}, {"metric_id": "m2", "metric_type": "trino_query"}],
           "query_results": [{"query_name": "q", "partition": {"dataset": "yellow", "year": 2011, "month": 1},
                              "result": {"rows": [["1"]], "columns": ["row_count"], "row_count": 1,
                                         "state": "FINISHED", "error": None}}],
           "dag_results": [{"dag_run_id": "d1", "state": "success"}]}
    p = tmp_path / "benchmark_run.json"
    p.write_text(json.dumps(art, indent=2))
    out = files.read_run_artifacts(spark, str(p))
    assert sorted(r.metric_id for r in out["metrics"].collect()) == ["m1", "m2"]
    assert out["query_results"].first().row_count == 1
    assert out["dag_results"].count() == 1


def test_read_event_log(spark, tmp_path):
    def acc(name, value):
        return {"ID": 1, "Name": name, "Value": value}
    events = [
        {"Event": "SparkListenerApplicationStart", "App ID": "app-1", "App Name": "stage"},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 0, "Stage Attempt ID": 0, "Accumulables": [
            acc("internal.metrics.input.recordsRead", 10), acc("internal.metrics.shuffle.read.remoteBytesRead", 5),
            acc("internal.metrics.shuffle.read.localBytesRead", 7)]}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 1, "Stage Attempt ID": 0,
                                                                "Failure Reason": "boom", "Accumulables": [
            acc("internal.metrics.input.recordsRead", 99)]}},
    ]
    p = tmp_path / "app-1"
    p.write_text("\n".join(json.dumps(e) for e in events))
    from tollgate.operators.evidence import app_counters, read_event_log
    stages = read_event_log(spark, str(p))
    r = app_counters(stages).first()
    assert (r.app_id, r.records_read, r.shuffle_read_bytes) == ("app-1", 10, 12)


def test_read_event_log_repeated_names_and_rolling_parts(spark, tmp_path):
    from tollgate.operators.evidence import app_counters, read_event_log
    folder = tmp_path / "eventlog_v2_app-7"
    folder.mkdir()
    metric = [{"ID": i, "Name": "number of output rows", "Value": i} for i in (1, 2)]
    stage = {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 0, "Stage Attempt ID": 0, "Accumulables": [
        *metric, {"ID": 3, "Name": "internal.metrics.input.recordsRead", "Value": 4}]}}
    start = {"Event": "SparkListenerApplicationStart", "App ID": "app-7", "App Name": "stage"}
    (folder / "events_1_app-7").write_text("\n".join(json.dumps(e) for e in (start, stage)))
    stage["Stage Info"]["Stage ID"] = 1
    (folder / "events_2_app-7").write_text(json.dumps(stage))
    (folder / "appstatus_app-7").write_text("")
    for path in (folder, tmp_path):
        rows = app_counters(read_event_log(spark, str(path))).collect()
        assert [(r.app_id, r.records_read) for r in rows] == [("app-7", 8)]


def test_reload_clears_moved_and_removed_rows(spark, tmp_table):
    schema = "metric_id string, run string, part string, v int"
    old = spark.createDataFrame([("m1", "r", "x", 1), ("m2", "r", "x", 1), ("m3", "r", "z", 1), ("m4", "s", "y", 1), ("m5", "s", None, 1)], schema)
    tables.overwrite_partitions(old, tmp_table, ["part"])
    new = spark.createDataFrame([("m1", "r", "y", 2), ("m2", "r", None, 2)], schema)
    for _ in range(2):
        tables.reload_by_key(spark, tmp_table, new, "metric_id", ["part"], scope=F.col("run") == "r")
        got = sorted((r.metric_id, r.part, r.v) for r in tables.read_table(spark, tmp_table).collect())
        assert got == [("m1", "y", 2), ("m2", None, 2), ("m4", "y", 1), ("m5", None, 1)]


def test_gate_holds_back_only_the_failed_month(spark, tmp_path):
    from tollgate.plans.jobs import Warehouse, medallion_run
    good = row(T0, T0 + dt.timedelta(minutes=5))
    bad = row(dt.datetime(2014, 2, 2), dt.datetime(2014, 2, 2, 0, 10))
    raw = raw_green(spark, [good, bad]).withColumn(
        "VendorID", F.when(F.month("lpep_pickup_datetime") == 2, 99).otherwise(F.col("VendorID")))
    wh = Warehouse(str(tmp_path / "wh"))
    out = medallion_run(spark, {"green": raw}, wh, parts=[(2014, 1), (2014, 2)])
    assert out["gold_built"] and out["hard_failures"] == {"green": True}
    assert [(r.year, r.month) for r in tables.read_table(spark, wh.gold).collect()] == [(2014, 1)]


def test_unreadable_month_fails_alone(spark, tmp_path):
    from tollgate.plans.jobs import Warehouse, audit_silver, build_silver
    raw = raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=5)), row(dt.datetime(2014, 2, 2), dt.datetime(2014, 2, 2, 0, 10))])
    wh = Warehouse(str(tmp_path / "wh"))
    build_silver(raw, "green", wh.silver("green"))
    # Data pages of the February file are spoilt, its footer is not: only reading it shows.
    part = next((tmp_path / "wh/silver/green_trips/year=2014/month=2").glob("*.parquet"))
    body = bytearray(part.read_bytes())
    tail = int.from_bytes(body[-8:-4], "little") + 8
    body[4:len(body) - tail] = b"\xff" * (len(body) - tail - 4)
    part.write_bytes(bytes(body))
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    rows, failed = audit_silver(spark, "green", wh.silver("green"), wh.quality, [(2014, 1), (2014, 2)])
    assert failed
    read = rows.where("check_name = 'silver_partition_read' and status = 'fail'").collect()
    assert [(r.year, r.month) for r in read] == [(2014, 2)]
    assert rows.where("month = 1").count() > 1


def test_streaming_gate(spark, tmp_path):
    base = str(tmp_path / "landing")
    raw = raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=5)), row(dt.datetime(2014, 2, 2), dt.datetime(2014, 2, 2, 0, 10))]).withColumn(
        "VendorID", F.when(F.month("lpep_pickup_datetime") == 2, 99).otherwise(F.col("VendorID")))
    files.land_raw(raw.withColumn("year", F.year("lpep_pickup_datetime")).withColumn("month", F.month("lpep_pickup_datetime")), base)
    wh = {k: str(tmp_path / k) for k in ("silver", "gold", "quality", "ckpt")}
    ingest.ingest_available(spark, base, raw.schema, "green", wh["silver"], wh["gold"], wh["ckpt"], wh["quality"])
    assert [r.month for r in tables.read_table(spark, wh["gold"]).collect()] == [1]


def test_run_template_binds_identifiers(spark):
    df = gold_rows(spark)
    out = files.run_template(spark, "SELECT sum(trip_count) AS n FROM IDENTIFIER(:t) WHERE year = :y",
                             {"tg_gold_view": df}, {"t": "tg_gold_view", "y": 2011})
    assert out.first().n == 30


def test_preview_ordered(spark):
    df = gold_rows(spark)
    assert [r.trip_count for r in marts.preview(df, [F.col("trip_count").desc()], 2).collect()] == [30, 20]


def test_calendar_gaps_next(spark):
    avail = spark.createDataFrame([(2014, 11), (2015, 2)], "year int, month int")
    cal = ingest.month_span(avail)
    assert cal.count() == 4
    assert sorted((r.year, r.month) for r in ingest.partition_gaps(cal, avail).collect()) == [(2014, 12), (2015, 1)]
    nxt = ingest.next_unloaded(cal, avail.where("month = 11")).first()
    assert (nxt.year, nxt.month) == (2014, 12)


def test_streaming_ingest_and_rerun(spark, tmp_path):
    base = str(tmp_path / "landing")
    rows = [row(T0, T0 + dt.timedelta(minutes=5)), row(T0, T0 + dt.timedelta(minutes=1)),
            row(dt.datetime(2014, 2, 2), dt.datetime(2014, 2, 2, 0, 10))]
    raw = raw_green(spark, rows)
    landed = raw.withColumn("year", F.year("lpep_pickup_datetime")).withColumn("month", F.month("lpep_pickup_datetime"))
    files.land_raw(landed.where("month = 1"), base)
    wh = {k: str(tmp_path / k) for k in ("silver", "gold", "quality", "ckpt")}
    ingest.ingest_available(spark, base, raw.schema, "green", wh["silver"], wh["gold"], wh["ckpt"], wh["quality"])
    assert [(r.month, r.trip_count) for r in tables.read_table(spark, wh["gold"]).collect()] == [(1, 2)]
    # a new month arrives: only it is processed on the next run (checkpointed cursor)
    landed.where("month = 2").write.mode("append").partitionBy("year", "month").parquet(base)
    ingest.ingest_available(spark, base, raw.schema, "green", wh["silver"], wh["gold"], wh["ckpt"], wh["quality"])
    got = sorted((r.month, r.trip_count) for r in tables.read_table(spark, wh["gold"]).collect())
    assert got == [(1, 2), (2, 1)]
    assert tables.read_table(spark, wh["quality"]).select("month").distinct().count() == 2


def test_streaming_month_split_across_batches(spark, tmp_path):
    base = str(tmp_path / "landing")
    raw = raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=5)), row(T0, T0 + dt.timedelta(minutes=7))])
    landed = raw.withColumn("year", F.year("lpep_pickup_datetime")).withColumn("month", F.month("lpep_pickup_datetime"))
    # two files of the same month, one file per micro-batch
    landed.limit(1).write.mode("append").partitionBy("year", "month").parquet(base)
    landed.exceptAll(landed.limit(1)).write.mode("append").partitionBy("year", "month").parquet(base)
    wh = {k: str(tmp_path / k) for k in ("silver", "gold", "ckpt")}
    ingest.ingest_available(spark, base, raw.schema, "green", wh["silver"], wh["gold"], wh["ckpt"],
                            files_per_trigger=1)
    assert [r.trip_count for r in tables.read_table(spark, wh["gold"]).collect()] == [2]
    assert tables.read_table(spark, wh["silver"]).count() == 2


def test_rewrite_layout_non_strict_small_partition(spark, tmp_path):
    df = spark.range(37).select(F.when(F.col("id") < 5, 1).otherwise(2).alias("month"), F.col("id"))
    target = str(tmp_path / "ns")
    layout.rewrite_layout(df, target, ["month"], "fragmented", n_files=8, strict=False)
    inv = {r.month: (r.file_count, r.empty_files, r.record_count)
           for r in layout.file_inventory(spark, target, ["month"]).collect()}
    assert inv == {"1": (5, 0, 5), "2": (8, 0, 32)}
    rows = spark.createDataFrame([(1, 5), (2, 32)], "month int, row_count long")
    gaps = layout.layout_gaps(layout.file_inventory(spark, target, ["month"]), rows, 8, ["month"]).collect()
    assert [(r.month, r.file_count) for r in gaps] == [("1", 5)]


def test_query_suite_templates(spark):
    from tollgate.operators import quality
    from tollgate.operators.normalize import normalize
    from tollgate.plans import suite

    s = normalize(raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=5), fare=10.0),
                                    row(T0, T0 + dt.timedelta(minutes=3), fare=20.0)]), "green")
    gold = marts.monthly_revenue(s, "green")
    audit = quality.audit(s, "green", context={"benchmark_run_id": "r1", "dag_run_id": "d"})
    tabs = {"silver": s, "quality": audit, "gold": gold}
    out = suite.run_suite(spark, tabs, "green", 2014, 1, run_id="r1")
    assert set(out) == set(suite.SUITE)
    assert out["01_partition_row_count"].first().row_count == 2
    assert out["03_gold_revenue_check"].first().trip_count == 2
    assert {r.status for r in out["02_quality_result_summary"].collect()} <= {"pass", "warn", "fail"}
    perf = suite.run_suite(spark, tabs, "green", 2014, 1, suite="performance")
    assert perf["03_dataset_financial_scan"].first().total_amount is not None
    corr = suite.run_suite(spark, tabs, "green", 2014, 1, suite="correctness")
    assert sum(r.check_count for r in corr["02_quality_result_summary"].collect()) == audit.count()
    with pytest.raises(ValueError):
        suite.run_query(spark, "01_partition_row_count", tabs)


def test_calendar_rollover(spark):
    cal = [(r.year, r.month) for r in ingest.calendar(2014, 11, 2015, 2).collect()]
    assert cal == [(2014, 11), (2014, 12), (2015, 1), (2015, 2)]


def test_rows_without_keys_keep_their_place(spark, tmp_table):
    from tollgate.operators.sequence import dense_index
    from tollgate.sources.layout import rewrite_layout
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 5)], "k string, v int")
    got = sorted((r["k"] or "", r["v"], r["i"]) for r in dense_index(df, ["k"], ["v"], name="i").collect())
    assert got == [("", 1, 0), ("", 3, 1), ("a", 2, 0), ("a", 5, 1)]
    rewrite_layout(df.withColumn("year", F.when(F.col("k").isNotNull(), 2020)), tmp_table, ["year"], "fragmented", n_files=2)
    assert spark.read.parquet(tmp_table).count() == 4


def test_stored_asks_the_file_system_of_the_path(spark, tmp_path):
    from tollgate.sources.files import stored

    assert stored(spark, str(tmp_path)) and stored(spark, f"file://{tmp_path}") and not stored(spark, f"file://{tmp_path}/no")


def test_layout_keeps_order_across_and_within_files(spark, tmp_path):
    import pyarrow.parquet as pq

    from tollgate.sources import layout

    df = spark.range(103).select((F.col("id") % 2).cast("int").alias("m"), ((F.col("id") * 37) % 103).alias("t"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 5, 1), (None, 5, 1), (None, 4, 0), (None, None, 2)], "m int, t long, v long"))
    for kind, n in (("fragmented", 4), ("compact", 1)):
        out = str(tmp_path / kind)
        layout.rewrite_layout(df, out, ["m"], kind, n_files=4, order=["t"])
        for part in ("m=0", "m=1", "m=__HIVE_DEFAULT_PARTITION__"):
            # A file is read by itself, so that its rows stay in their stored order.
            files = [pq.ParquetFile(f).read(["t"])["t"].to_pylist() for f in (tmp_path / kind / part).glob("*.parquet")]
            files = [[-1 if t is None else t for t in f] for f in files]
            assert len(files) == n and all(f == sorted(f) for f in files)
            files.sort()
            assert all(a[-1] <= b[0] for a, b in zip(files, files[1:]))
            assert max(map(len, files)) - min(map(len, files)) <= 1
        assert sorted(map(str, spark.read.parquet(out).select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_layout_reads_its_source_once_and_cuts_evenly(spark, tmp_path):
    import pyarrow.parquet as pq

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = (spark.range(0, 205, 1, 7).select(F.when(F.col("id") < 200, (F.col("id") % 2).cast("int")).alias("m"), F.col("id").alias("v"))
          .mapInArrow(counted, "m int, v long"))
    layout.rewrite_layout(df, str(tmp_path / "out"), ["m"], "fragmented", n_files=8, strict=False)
    assert read.value == 205
    for part, sizes in (("m=0", [12] * 4 + [13] * 4), ("m=1", [12] * 4 + [13] * 4), ("m=__HIVE_DEFAULT_PARTITION__", [1] * 5)):
        files = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "out" / part).glob("*.parquet")]
        assert sorted(files) == sizes
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(205))
