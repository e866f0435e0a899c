"""Registered queries that write and read back tables.

Every query writes under a fresh folder of the session's shared
checkpoint root and returns the read-back table, so the check covers the
write path (partition overwrite, append, reload, evolution, layout,
streaming ingest) and not only the plan.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators import marts, quality
from tollgate.operators.metric_rows import layout_rows, pipeline_rows, query_rows, task_rows, union_metrics
from tollgate.operators.normalize import following_columns
from tollgate.plans import oracle
from tollgate.plans.datasets import silver, silver_all
from tollgate.plans.jobs import Warehouse, medallion_run
from tollgate.plans.registry import (ADAPTER_MIN_YEAR, AUDIT_RUNS, GOLD_ROUND, GOLD_SQL, _audit_frames,
                                     _audit_sql_all, register, rnd)
from tollgate.plans.registry_metrics import _rm
from tollgate.schemas import (GOLD_PARTITION_COLUMNS, QUALITY_PARTITION_COLUMNS, RUN_METRICS,
                              SILVER_PARTITION_COLUMNS)
from tollgate.session import checkpoint_root, exists, work_path
from tollgate.sources import files, layout, tables
from tollgate.sources.adapters import TASK_IDS, raw_trips, staged_raw_trips, table
from tollgate.streaming import ingest

DATASETS = ("yellow", "green")


def _each(fn):
    """``fn(spark, sf, dataset)`` of both datasets in one frame, told apart by a dataset column."""
    def query(spark, sf):
        yellow, green = (fn(spark, sf, d) for d in DATASETS)
        return yellow.select(F.lit("yellow").alias("dataset"), "*").unionByName(green.select(F.lit("green").alias("dataset"), "*"))
    return query


def _each_sql(body: str) -> str:
    """``body`` over {silver} of both datasets, told apart by a dataset column."""
    return oracle.with_silver(" UNION ALL ".join(
        f"SELECT '{d}' AS dataset, q_{d}.* FROM ({body.format(silver='silver_' + d)}) q_{d}" for d in DATASETS))


# ---------------------------------------------------------------------------
# S6 / S7 / S9 / S10
# ---------------------------------------------------------------------------


def _partition_overwrite(spark, sf):
    target = work_path(spark, "gold")
    gold = marts.monthly_revenue(silver_all(spark, sf))
    tables.overwrite_partitions(gold, target, GOLD_PARTITION_COLUMNS)
    # Retry of one dataset: only its partitions are replaced.
    tables.overwrite_partitions(gold.where(F.col("dataset") == "yellow"), target, GOLD_PARTITION_COLUMNS)
    # A zero-row frame replaces nothing.
    tables.overwrite_partitions(gold.where(F.lit(False)), target, GOLD_PARTITION_COLUMNS)
    return rnd(tables.read_table(spark, target).drop("processed_at"), GOLD_ROUND)


register("partition_overwrite", GOLD_SQL)(_partition_overwrite)


def _audit_append(spark, sf):
    target = work_path(spark, "audit")
    for run in AUDIT_RUNS[:2]:
        tables.append_rows(_audit_frames(spark, sf, [run]), target, QUALITY_PARTITION_COLUMNS)
    return tables.read_table(spark, target).drop("processed_at")


register("audit_append", oracle.with_silver(_audit_sql_all(AUDIT_RUNS[:2])))(_audit_append)

OLD_COLUMNS = 20


def _schema_evolution(spark, sf):
    target = work_path(spark, "metrics-v1")
    old = _rm(spark, sf).select(*[f.name for f in RUN_METRICS.fields[:OLD_COLUMNS]])
    old.write.mode("overwrite").parquet(target)
    added = tables.evolve_schema(spark, target, RUN_METRICS)
    assert len(added) == len(RUN_METRICS.fields) - OLD_COLUMNS
    return tables.read_evolved(spark, target, RUN_METRICS)


_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "timestamp": "TIMESTAMP"}
register("schema_evolution", oracle.with_metrics("SELECT " + ", ".join(
    f.name if i < OLD_COLUMNS else f"CAST(NULL AS {_DUCK[f.dataType.simpleString()]}) AS {f.name}"
    for i, f in enumerate(RUN_METRICS.fields)) + " FROM run_metrics"))(_schema_evolution)


def _replace_by_key(spark, sf):
    target = work_path(spark, "metrics")
    parts = ["architecture", "metric_type"]
    rm = _rm(spark, sf).select("metric_id", "architecture", "metric_type", "duration_seconds")
    tables.overwrite_partitions(rm, target, parts)
    reload = rm.where(F.col("architecture") == "onprem").withColumn("duration_seconds", F.col("duration_seconds") * 2)
    checkpoint_root(spark)
    for _ in range(2):  # reloading the same artifact twice leaves one row per id
        existing = tables.read_table(spark, target)
        touched = existing.join(reload.select("architecture", "metric_type").distinct(), parts, "left_semi")
        content = tables.replace_by_key(touched, reload, "metric_id").checkpoint(eager=True)
        tables.overwrite_partitions(content, target, parts)
    return tables.read_table(spark, target)


register("replace_by_key", oracle.with_metrics(
    "SELECT metric_id, architecture, metric_type, CASE WHEN architecture = 'onprem' THEN duration_seconds * 2 "
    "ELSE duration_seconds END AS duration_seconds FROM run_metrics"))(_replace_by_key)


def _reload_by_key(spark, sf):
    """A run reloaded twice: some of its rows changed partition, some are gone from the artifact."""
    target = work_path(spark, "metrics")
    parts = ["architecture", "metric_type"]
    rm = _rm(spark, sf).select("metric_id", "architecture", "metric_type", "duration_seconds")
    tables.overwrite_partitions(rm, target, parts)
    run = F.col("architecture") == "onprem"
    artifact = rm.where(run & (F.col("duration_seconds") >= 5)).select(
        "metric_id", F.when(F.col("duration_seconds") > 50, "moved").otherwise(F.col("architecture")).alias("architecture"),
        "metric_type", (F.col("duration_seconds") * 2).alias("duration_seconds"))
    for _ in range(2):
        tables.reload_by_key(spark, target, artifact, "metric_id", parts, scope=run)
    return tables.read_table(spark, target)


register("reload_by_key", oracle.with_metrics("""
SELECT metric_id, CASE WHEN architecture = 'onprem' AND duration_seconds > 50 THEN 'moved' ELSE architecture END AS architecture, metric_type,
       CASE WHEN architecture = 'onprem' THEN duration_seconds * 2 ELSE duration_seconds END AS duration_seconds
FROM run_metrics WHERE architecture <> 'onprem' OR duration_seconds >= 5"""))(_reload_by_key)


# ---------------------------------------------------------------------------
# S12 / S13 / A14 / J10 / S14 / J13
# ---------------------------------------------------------------------------

N_FILES = 16
ORDERED_FILES = 4
# (sf_dir, layout, dataset) -> rewritten table: the layout queries share one rewrite
# per process (the rewrite is deterministic for a given input).
_LAYOUTS: dict[tuple[str, str, str], str] = {}


def _rewritten(spark, sf, kind, dataset="yellow"):
    key = (sf, kind, dataset)
    if key in _LAYOUTS and exists(_LAYOUTS[key]):
        return _LAYOUTS[key]
    target = work_path(spark, f"layout-{kind}-{dataset}")
    layout.rewrite_layout(silver(spark, sf, dataset), target, SILVER_PARTITION_COLUMNS, kind,
                          n_files=N_FILES, strict=False)
    _LAYOUTS[key] = target
    return target


def _ordered(spark, sf):
    """Rows and pickup range of every file, after a rewrite in pickup order."""
    out = []
    for ds in DATASETS:
        target = work_path(spark, f"layout-ordered-{ds}")
        layout.rewrite_layout(silver(spark, sf, ds), target, SILVER_PARTITION_COLUMNS, "fragmented", n_files=ORDERED_FILES, strict=False, order=["pickup_ts"])
        out.append(tables.read_table(spark, target).groupBy("year", "month", F.col("_metadata.file_path").alias("_file")).agg(
            F.count(F.lit(1)).alias("records"), F.min("pickup_ts").alias("first_pickup"), F.max("pickup_ts").alias("last_pickup"))
            .select(F.lit(ds).alias("dataset"), F.col("year").cast("int"), F.col("month").cast("int"), "records", "first_pickup", "last_pickup"))
    return out[0].unionByName(out[1])


register("layout_ordered", oracle.with_silver(f"""
SELECT dataset, year, month, count(*) AS records, min(pickup_ts) AS first_pickup, max(pickup_ts) AS last_pickup
FROM (SELECT dataset, year, month, pickup_ts,
             ((row_number() OVER (PARTITION BY dataset, year, month ORDER BY pickup_ts) - 1) * {ORDERED_FILES})
             // count(*) OVER (PARTITION BY dataset, year, month) AS file
      FROM silver_all)
GROUP BY dataset, year, month, file"""))(_ordered)


def _inventory(spark, target):
    inv = layout.file_inventory(spark, target, SILVER_PARTITION_COLUMNS)
    return inv.select(F.col("year").cast("int"), F.col("month").cast("int"), "file_count", "empty_files",
                      "record_count")


register("layout_fragmented", oracle.with_silver(
    f"SELECT year, month, least({N_FILES}, count(*)) AS file_count, CAST(0 AS BIGINT) AS empty_files, "
    "count(*) AS record_count FROM silver_yellow GROUP BY year, month"))(
    lambda spark, sf: _inventory(spark, _rewritten(spark, sf, "fragmented")))

register("layout_compact", oracle.with_silver(
    "SELECT year, month, CAST(1 AS BIGINT) AS file_count, CAST(0 AS BIGINT) AS empty_files, "
    "count(*) AS record_count FROM silver_yellow GROUP BY year, month"))(
    lambda spark, sf: _inventory(spark, _rewritten(spark, sf, "compact")))

register("layout_fragmented_both", _each_sql(
    f"SELECT year, month, least({N_FILES}, count(*)) AS file_count, CAST(0 AS BIGINT) AS empty_files, "
    "count(*) AS record_count FROM {silver} GROUP BY year, month"))(
    _each(lambda spark, sf, d: _inventory(spark, _rewritten(spark, sf, "fragmented", d))))

register("layout_compact_both", _each_sql(
    "SELECT year, month, CAST(1 AS BIGINT) AS file_count, CAST(0 AS BIGINT) AS empty_files, "
    "count(*) AS record_count FROM {silver} GROUP BY year, month"))(
    _each(lambda spark, sf, d: _inventory(spark, _rewritten(spark, sf, "compact", d))))


def _layout_gaps(spark, sf, dataset="yellow"):
    target = _rewritten(spark, sf, "fragmented", dataset)
    inv = layout.file_inventory(spark, target, SILVER_PARTITION_COLUMNS)
    rows = marts.row_count(silver(spark, sf, dataset), by=["year", "month"])
    gaps = layout.layout_gaps(inv, rows, N_FILES, SILVER_PARTITION_COLUMNS)
    return gaps.select(F.col("year").cast("int"), F.col("month").cast("int"), "file_count", "row_count",
                       "expected_files")


register("layout_gaps", oracle.with_silver(
    f"SELECT year, month, count(*) AS file_count, count(*) AS row_count, {N_FILES} AS expected_files "
    f"FROM silver_yellow GROUP BY year, month HAVING count(*) < {N_FILES}"))(_layout_gaps)
register("layout_gaps_both", _each_sql(
    f"SELECT year, month, count(*) AS file_count, count(*) AS row_count, {N_FILES} AS expected_files "
    f"FROM {{silver}} GROUP BY year, month HAVING count(*) < {N_FILES}"))(_each(_layout_gaps))


def _layout_totals(spark, sf, dataset="yellow"):
    inv = layout.file_inventory(spark, _rewritten(spark, sf, "fragmented", dataset), SILVER_PARTITION_COLUMNS)
    return layout.layout_totals(inv).drop("total_size")


register("layout_totals", oracle.with_silver(
    f"SELECT sum(c) AS record_count, sum(least({N_FILES}, c)) AS file_count "
    "FROM (SELECT count(*) AS c FROM silver_yellow GROUP BY year, month)"))(_layout_totals)
register("layout_totals_both", _each_sql(
    f"SELECT sum(c) AS record_count, sum(least({N_FILES}, c)) AS file_count "
    "FROM (SELECT count(*) AS c FROM {silver} GROUP BY year, month)"))(_each(_layout_totals))


def _checksums(spark, sf, dataset):
    target = _rewritten(spark, sf, "compact", dataset)
    recorded = files.relative(files.checksum_manifest(spark, target), target).checkpoint(eager=True)
    observed = files.relative(files.checksum_manifest(spark, target), target)
    return files.compare_manifests(recorded, observed).select("key", "mismatch")


register("checksum_manifest")(_each(_checksums))  # paths and digests are engine-specific: rows-only


# ---------------------------------------------------------------------------
# S2 scan of a landing zone, S4 preview, S18 template
# ---------------------------------------------------------------------------

def _landed(spark, sf, dataset):
    base = work_path(spark, f"landing-{dataset}")
    raw = raw_trips(spark, sf, dataset)
    pickup = "tpep_pickup_datetime" if dataset == "yellow" else "lpep_pickup_datetime"
    files.land_raw(raw.withColumn("year", F.year(pickup)).withColumn("month", F.month(pickup)), base)
    return base


def _landed_scan(spark, sf, dataset="yellow"):
    base = _landed(spark, sf, dataset)
    raw = files.scan_glob(spark, base, "*.parquet").drop("year", "month")
    from tollgate.operators.normalize import normalize
    gold = marts.monthly_revenue(normalize(raw, dataset), dataset)
    return rnd(gold.drop("processed_at"), GOLD_ROUND)


register("landed_scan", GOLD_SQL.replace("FROM silver_all GROUP BY", "FROM silver_all WHERE dataset = 'yellow' GROUP BY"))(
    _landed_scan)
register("landed_scan_both", GOLD_SQL)(
    lambda spark, sf: _landed_scan(spark, sf, "yellow").unionByName(_landed_scan(spark, sf, "green")))


def _land_drifting(spark, sf, dataset):
    """Month files filed by dropoff month, whose types and names drift from year to year; returns base and months."""
    base, staged = work_path(spark, f"raw-{dataset}"), work_path(spark, f"staged-{dataset}")
    dropoff = "tpep_dropoff_datetime" if dataset == "yellow" else "lpep_dropoff_datetime"
    raw = raw_trips(spark, sf, dataset).withColumn("year", F.year(dropoff)).withColumn("month", F.month(dropoff))
    drifts = [
        lambda d: d,
        lambda d: d.withColumns({"passenger_count": F.col("passenger_count").cast("int"), "PULocationID": F.col("PULocationID").cast("int"),
                                 "RatecodeID": F.col("RatecodeID").cast("double"), "extra": F.lit(None).cast("int")}),
        lambda d: d.withColumns({"passenger_count": F.col("passenger_count").cast("double"), "extra": F.lit(None).cast("double")})
        .withColumnRenamed("RatecodeID", "RateCodeID"),
    ]
    for i, drift in enumerate(drifts):
        drift(raw.where(F.col("year") % len(drifts) == i)).write.mode("append").partitionBy("year", "month").parquet(staged)
    months = sorted((r.year, r.month) for r in raw.select("year", "month").distinct().collect())
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for (y, m), target in zip(months, files.month_paths(base, dataset, months)):
        store.mkdirs(path(target).getParent())
        store.rename(path(f"{staged}/year={y}/month={m}"), path(target))
    return base, months


def _drifting_months(spark, sf):
    out = []
    for ds in DATASETS:
        base, months = _land_drifting(spark, sf, ds)
        # A year more on both sides: months without a file come back as rows.
        asked = [(y, m) for y in range(months[0][0] - 1, months[-1][0] + 2) for m in range(1, 13)]
        rows, inventory = files.scan_months(spark, base, ds, asked)
        pickup = F.col("tpep_pickup_datetime" if ds == "yellow" else "lpep_pickup_datetime")
        kept = rows.where((F.year(pickup) == F.col("file_year")) & (F.month(pickup) == F.col("file_month")))  # P11
        counts = kept.groupBy(F.col("file_year").alias("year"), F.col("file_month").alias("month")).agg(
            F.count(F.lit(1)).alias("trips"), F.sum("passenger_count").alias("passengers"), F.sum("RatecodeID").alias("rate_codes"),
            F.count("extra").alias("extras"))
        out.append(inventory.join(counts, ["year", "month"], "left").select(
            "dataset", "year", "month", "status", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("trips", "passengers", "rate_codes", "extras")]))
    return out[0].unionByName(out[1])


register("drifting_months", f"""
WITH {oracle.RAW_TRIPS},
span AS (SELECT dataset, min(year(dropoff)) AS lo, max(year(dropoff)) AS hi FROM raw_trips GROUP BY dataset),
years AS (SELECT dataset, unnest(range(lo - 1, hi + 2)) AS year FROM span),
months AS (SELECT dataset, year, unnest(range(1, 13)) AS month FROM years),
filed AS (SELECT dataset, year(dropoff) AS year, month(dropoff) AS month,
                 sum(CASE WHEN year(pickup) = year(dropoff) AND month(pickup) = month(dropoff) THEN 1 ELSE 0 END) AS trips,
                 sum(CASE WHEN year(pickup) = year(dropoff) AND month(pickup) = month(dropoff) THEN passengers ELSE 0 END) AS passengers,
                 sum(CASE WHEN year(pickup) = year(dropoff) AND month(pickup) = month(dropoff) THEN ratecode ELSE 0 END) AS rate_codes
          FROM raw_trips GROUP BY ALL)
SELECT m.dataset, CAST(m.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month, CASE WHEN f.trips IS NULL THEN 'missing' ELSE 'present' END AS status,
       CAST(coalesce(f.trips, 0) AS BIGINT) AS trips, CAST(coalesce(f.passengers, 0) AS BIGINT) AS passengers,
       CAST(coalesce(f.rate_codes, 0) AS BIGINT) AS rate_codes, CAST(0 AS BIGINT) AS extras
FROM months m LEFT JOIN filed f ON m.dataset = f.dataset AND m.year = f.year AND m.month = f.month""")(_drifting_months)


def _drifting_glob(spark, sf):
    """S2 over files of both drifting datasets, through staging to gold."""
    from tollgate.operators.normalize import normalize

    out = []
    for ds in DATASETS:
        base, _ = _land_drifting(spark, sf, ds)
        out.append(marts.monthly_revenue(normalize(files.scan_glob(spark, base, "*.parquet"), ds), ds).drop("processed_at"))
    return rnd(out[0].unionByName(out[1]), GOLD_ROUND)


register("drifting_glob", GOLD_SQL)(_drifting_glob)

_ALL = ["vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "rate_code_id",
        "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id", "payment_type", "fare_amount",
        "tip_amount", "tolls_amount", "total_amount", "trip_duration_min", "year", "month"]


#: Columns whose type differs between the datasets, with the wider one.
_WIDE = {**dict.fromkeys(["vendor_id", "passenger_count", "rate_code_id", "pickup_location_id", "dropoff_location_id",
                          "payment_type"], "bigint"), "trip_distance": "double", "trip_duration_min": "double"}


def _preview(spark, sf, dataset="yellow"):
    s = silver(spark, sf, dataset).select(*_ALL)
    return marts.preview(s, [F.col("total_amount").desc(), *[F.col(c) for c in _ALL if c != "total_amount"]], 5)


register("preview_top_trips", oracle.with_silver(
    f"SELECT {', '.join(_ALL)} FROM silver_yellow ORDER BY total_amount DESC, "
    + ", ".join(c for c in _ALL if c != "total_amount") + " LIMIT 5"))(_preview)

register("preview_top_trips_both", _each_sql(
    f"SELECT {', '.join(f'CAST({c} AS {_WIDE[c]}) AS {c}' if c in _WIDE else c for c in _ALL)} "
    "FROM (SELECT * FROM {silver} ORDER BY total_amount DESC, "
    + ", ".join(c for c in _ALL if c != "total_amount") + " LIMIT 5)"))(
    _each(lambda spark, sf, d: _preview(spark, sf, d).select(
        *[F.col(c).cast(_WIDE[c]).alias(c) if c in _WIDE else c for c in _ALL])))

TEMPLATE = """
SELECT sum(total_amount) AS total_amount,
       avg(trip_distance) AS avg_trip_distance,
       avg(trip_duration_min) AS avg_trip_duration_min
FROM IDENTIFIER(:silver_table)
WHERE year >= :min_year
"""


def _template(spark, sf, dataset="yellow"):
    view = f"tollgate_silver_{dataset}_" + work_path(spark, "v").rsplit("-", 1)[-1]
    out = files.run_template(spark, TEMPLATE, {view: silver(spark, sf, dataset)},
                             {"silver_table": view, "min_year": ADAPTER_MIN_YEAR})
    return rnd(out, {"total_amount": 2, "avg_trip_distance": 6, "avg_trip_duration_min": 6})


register("sql_template_broad_scan", oracle.with_silver(
    "SELECT round(sum(total_amount), 2) AS total_amount, round(avg(trip_distance), 6) AS avg_trip_distance, "
    f"round(avg(trip_duration_min), 6) AS avg_trip_duration_min FROM silver_yellow WHERE year >= {ADAPTER_MIN_YEAR}"))(
    _template)
register("sql_template_broad_scan_both", _each_sql(
    "SELECT round(sum(total_amount), 2) AS total_amount, round(avg(trip_distance), 6) AS avg_trip_distance, "
    f"round(avg(trip_duration_min), 6) AS avg_trip_duration_min FROM {{silver}} WHERE year >= {ADAPTER_MIN_YEAR}"))(
    _each(_template))


# ---------------------------------------------------------------------------
# Calendar, gaps, streaming ingest, re-run idempotence
# ---------------------------------------------------------------------------

def _available(spark, sf, dataset="green"):
    return silver(spark, sf, dataset).select("year", "month").distinct()


def _calendar(spark, sf, dataset="green"):
    avail = _available(spark, sf, dataset)
    cal = ingest.month_span(avail)
    nxt = ingest.next_partition(F.col("year"), F.col("month"))
    have = avail.withColumn("available", F.lit(True))
    return cal.join(have, ["year", "month"], "left").select(
        "year", "month", nxt["year"].alias("next_year"), nxt["month"].alias("next_month"),
        F.coalesce("available", F.lit(False)).alias("available"))


register("partition_calendar", oracle.with_silver("""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(year(d + INTERVAL 1 MONTH) AS INTEGER) AS next_year, CAST(month(d + INTERVAL 1 MONTH) AS INTEGER) AS next_month,
       (year(d), month(d)) IN (SELECT (year, month) FROM silver_green) AS available
FROM (SELECT unnest(generate_series(min(make_date(year, month, 1)), max(make_date(year, month, 1)), INTERVAL 1 MONTH)) AS d
      FROM silver_green)"""))(_calendar)
register("partition_calendar_both", _each_sql("""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(year(d + INTERVAL 1 MONTH) AS INTEGER) AS next_year, CAST(month(d + INTERVAL 1 MONTH) AS INTEGER) AS next_month,
       (year(d), month(d)) IN (SELECT (year, month) FROM {silver}) AS available
FROM (SELECT unnest(generate_series(min(make_date(year, month, 1)), max(make_date(year, month, 1)), INTERVAL 1 MONTH)) AS d
      FROM {silver})"""))(_each(_calendar))


def _ingest(spark, sf):
    root = work_path(spark, "incremental")
    wh = {"silver": f"{root}/silver", "gold": f"{root}/gold", "quality": f"{root}/quality"}
    for ds in ("yellow", "green"):
        base = _landed(spark, sf, ds)
        schema = raw_trips(spark, sf, ds).schema
        ingest.ingest_available(
            spark, base, schema, ds, f"{wh['silver']}/{ds}", wh["gold"], f"{root}/checkpoints/{ds}",
            quality_path=wh["quality"], files_per_trigger=128,
            rules=quality.silver_rules(ds, ADAPTER_MIN_YEAR), gate=False)
    return rnd(tables.read_table(spark, wh["gold"]).drop("processed_at"), GOLD_ROUND)


register("incremental_ingest", GOLD_SQL)(_ingest)


#: The gate of ``ingest_gated`` and ``medallion_gated``: months before this year (the data's first) fail it.
GATE_YEAR = 1996


def _ingest_gated(spark, sf):
    """Two runs of a gated ingest, the second done again as after a crash before it was settled."""
    root = work_path(spark, "gated")
    rules = [quality.Rule("year", "ge", GATE_YEAR)]
    out = []
    for ds in DATASETS:
        base, schema, book = _landed(spark, sf, ds), raw_trips(spark, sf, ds).schema, ingest.Ledger(spark, f"{root}/{ds}/ledger")
        paths = (f"{root}/silver/{ds}", f"{root}/quality", f"{root}/gold")
        for _ in range(2):  # the second run finds no new files and tries the failed months again
            ingest.ingest_available(spark, base, schema, ds, paths[0], paths[2], f"{root}/{ds}/checkpoint", quality_path=paths[1],
                                    files_per_trigger=16, rules=rules, ledger=f"{root}/{ds}/ledger")
        retried = [(r.year, r.month, r.batch_id, r.attempt) for r in book.last(ds).where("attempt > 0").collect()]
        full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        if retried:
            ingest.rebuild_months(spark, retried, ds, base, full, *paths, rules=rules)
        out.append(book.last(ds).select(F.lit(ds).alias("dataset"), "year", "month", "status", (F.col("attempt") + 1).alias("rebuilds")))
    runs = tables.read_table(spark, f"{root}/quality").groupBy("dataset", "year", "month").agg(
        F.countDistinct("dag_run_id").alias("audit_runs"), F.count_if(F.col("check_name") == "pandera_validation").alias("rule_rows"))
    gold = tables.read_table(spark, f"{root}/gold").select("dataset", "year", "month", "trip_count")
    keys = ["dataset", "year", "month"]
    return out[0].unionByName(out[1]).join(runs, keys, "left").join(gold, keys, "left")


register("ingest_gated", oracle.with_silver(f"""
SELECT dataset, year, month, CASE WHEN year >= {GATE_YEAR} THEN 'done' ELSE 'failed' END AS status,
       CAST(CASE WHEN year >= {GATE_YEAR} THEN 1 ELSE 2 END AS INTEGER) AS rebuilds,
       CAST(CASE WHEN year >= {GATE_YEAR} THEN 1 ELSE 2 END AS BIGINT) AS audit_runs,
       CAST(CASE WHEN year >= {GATE_YEAR} THEN 1 ELSE 2 END AS BIGINT) AS rule_rows,
       CASE WHEN year >= {GATE_YEAR} THEN count(*) END AS trip_count
FROM silver_all GROUP BY dataset, year, month"""))(_ingest_gated)


def _medallion_gated(spark, sf):
    """C1 to C4 over both datasets: silver, audits and gold as stored, months before the gate's year held back."""
    house = Warehouse(work_path(spark, "medallion"))
    rules = [quality.Rule("year", "ge", GATE_YEAR)]
    run = medallion_run(spark, {ds: raw_trips(spark, sf, ds) for ds in DATASETS}, house, context={"benchmark_run_id": "run", "repetition": 1},
                        rules={ds: rules for ds in DATASETS})
    keys = ["dataset", "year", "month"]
    trips = [tables.read_table(spark, house.silver(ds)).select(F.lit(ds).alias("dataset"), *keys[1:]) for ds in DATASETS]
    silver_rows = trips[0].unionByName(trips[1]).groupBy(*keys).agg(F.count(F.lit(1)).alias("silver_rows"))
    audits = tables.read_table(spark, house.quality).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("audit_rows"), F.count_if((F.col("severity") == "hard") & (F.col("status") == "fail")).alias("hard_failures"))
    gold = tables.read_table(spark, house.gold).select(*keys, "trip_count")
    held = run["failed_partitions"].withColumn("held", F.lit(True))
    return (silver_rows.join(audits, keys, "left").join(gold, keys, "left").join(held, keys, "left")
            .withColumn("held", F.coalesce("held", F.lit(False))))


register("medallion_gated", oracle.with_silver(f"""
SELECT dataset, year, month, count(*) AS silver_rows, CAST(5 AS BIGINT) AS audit_rows,
       CAST(CASE WHEN year < {GATE_YEAR} THEN 1 ELSE 0 END AS BIGINT) AS hard_failures,
       CASE WHEN year >= {GATE_YEAR} THEN count(*) END AS trip_count, year < {GATE_YEAR} AS held
FROM silver_all GROUP BY dataset, year, month"""))(_medallion_gated)


def _rerun(spark, sf, dataset="green"):
    target = work_path(spark, f"silver-rerun-{dataset}")
    checkpoint_root(spark)
    keys, following = ["year", "month"], following_columns(dataset)
    # Both runs normalize, cluster and write all trips; only the join that makes the raw trips is shared.
    with staged_raw_trips(spark, sf, dataset) as raw:
        s = silver(spark, sf, dataset, raw)
        tables.overwrite_partitions(s, target, SILVER_PARTITION_COLUMNS, order=["pickup_ts"], following=following)
        # Snapshot the counts of run 1 before run 2 overwrites the partitions.
        first = ingest.partition_counts(tables.read_table(spark, target), keys).checkpoint(eager=True)
        tables.overwrite_partitions(s, target, SILVER_PARTITION_COLUMNS, order=["pickup_ts"], following=following)
    second = ingest.partition_counts(tables.read_table(spark, target), keys)
    out = ingest.rerun_consistency(first, second, keys)
    return out.select(F.col("year").cast("int"), F.col("month").cast("int"), "records_first", "records_second",
                      "consistent")


register("rerun_idempotence", oracle.with_silver(
    "SELECT year, month, count(*) AS records_first, count(*) AS records_second, true AS consistent "
    "FROM silver_green GROUP BY year, month"))(_rerun)
register("rerun_idempotence_both", _each_sql(
    "SELECT year, month, count(*) AS records_first, count(*) AS records_second, true AS consistent "
    "FROM {silver} GROUP BY year, month"))(_each(_rerun))


# ---------------------------------------------------------------------------
# Heterogeneous metric rows
# ---------------------------------------------------------------------------

def _metric_sources(spark, sf):
    ev = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    arch = F.when(F.col("event_id") % 2 == 0, F.lit("onprem")).otherwise(F.lit("hybrid_aws"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    end = F.timestamp_micros(F.unix_micros(F.to_timestamp("ts")) + F.round(F.col("value") * 1e6).cast("bigint"))
    base = ev.select(
        "event_type", "event_id", "value", k.alias("k"), F.to_timestamp("ts").alias("ts"), end.alias("end"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string"), F.lit("-"), arch).alias("benchmark_run_id"),
        arch.alias("architecture"),
        F.concat(F.lit("dag-"), F.col("event_id").cast("string")).alias("dag_run_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("green")).otherwise(F.lit("yellow")).alias("dataset"),
        F.when(F.col("user_id") % 2 == 0, F.lit(2014)).otherwise(F.lit(2011)).alias("year"),
        ((k % 4) * 3 + 1).cast("int").alias("month"), (k % 3 + 1).cast("int").alias("repetition"),
    )
    pipe = base.where(F.col("event_type") == "purchase").select(
        "benchmark_run_id", "architecture", "dag_run_id", "dataset", "year", "month", "repetition",
        F.lit("success").alias("state"), iso(F.col("ts")).alias("start_date"), iso(F.col("end")).alias("end_date"))
    task = base.where(F.col("event_type") == "signup").select(
        "benchmark_run_id", "architecture", "dag_run_id", "dataset", "year", "month", "repetition",
        F.element_at(F.array(*[F.lit(t) for t in TASK_IDS]), (F.col("k") % 3 + 1).cast("int")).alias("task_id"),
        F.lit("success").alias("state"),
        F.concat(F.lit("app-"), F.col("event_id").cast("string")).alias("spark_application_id"),
        iso(F.col("ts")).alias("start_date"), iso(F.col("end")).alias("end_date"),
        F.when(F.col("k") % 5 != 0, F.col("value")).alias("duration"))
    query = base.where(F.col("event_type").isin("click", "view")).select(
        "benchmark_run_id", "architecture", "dag_run_id", "dataset", "year", "month", "repetition",
        F.col("event_type").alias("query_name"), F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("query_id"),
        (F.col("k") % 5 + 1).cast("int").alias("query_repetition"), F.lit("FINISHED").alias("state"),
        iso(F.col("ts")).alias("started_at"), iso(F.col("end")).alias("finished_at"),
        F.col("value").alias("duration_seconds"), (F.col("k") * 10).alias("processed_rows"),
        (F.col("k") % 7).alias("row_count"), ((F.col("k") + 1) * 4096).alias("physical_input_bytes"))
    snap = base.where(F.col("event_type") == "error").select(
        "benchmark_run_id", "architecture", "dag_run_id", "dataset", "year", "month", "repetition",
        F.concat(F.lit("silver."), F.col("dataset"), F.lit("_trips")).alias("table_name"),
        (F.col("k") * 1000).alias("record_count"), (F.col("k") % 16 + 1).alias("file_count"),
        ((F.col("k") + 1) * 65536).alias("total_size"))
    return pipe, task, query, snap


def _metric_union(spark, sf):
    pipe, task, query, snap = _metric_sources(spark, sf)
    return union_metrics(pipeline_rows(pipe), task_rows(task), query_rows(query), layout_rows(snap))


def _union_sql() -> str:
    tasks = ", ".join(f"'{t}'" for t in TASK_IDS)
    mm = "lpad(CAST(month AS VARCHAR), 2, '0')"
    common = {"benchmark_run_id": "benchmark_run_id", "architecture": "architecture", "dag_run_id": "dag_run_id",
              "dataset": "dataset", "year": "year", "month": "month", "repetition": "repetition"}
    shapes = [
        ("purchase", {**common, "metric_id": "dag_run_id || '__pipeline'", "metric_type": "'pipeline'",
                      "status": "'success'", "started_at": "ts", "finished_at": "fin",
                      "duration_seconds": "(epoch_us(fin) - epoch_us(ts)) / 1000000.0"}),
        ("signup", {**common, "metric_id": f"dag_run_id || '__task__' || [{tasks}][k % 3 + 1]",
                    "metric_type": "'airflow_task'", "task_id": f"[{tasks}][k % 3 + 1]", "status": "'success'",
                    "spark_application_id": "'app-' || CAST(event_id AS VARCHAR)", "started_at": "ts",
                    "finished_at": "fin",
                    "duration_seconds": "coalesce(CASE WHEN k % 5 <> 0 THEN value END, (epoch_us(fin) - epoch_us(ts)) / 1000000.0)"}),
        ("query", {**common,
                   "metric_id": f"benchmark_run_id || '__' || dataset || '_' || CAST(year AS VARCHAR) || '_' || {mm} || '__query__' || event_type || '__qr' || lpad(CAST(k % 5 + 1 AS VARCHAR), 2, '0')",
                   "metric_type": "'trino_query'", "query_name": "event_type", "query_id": "'q' || CAST(event_id AS VARCHAR)",
                   "status": "'FINISHED'", "started_at": "ts", "finished_at": "fin", "duration_seconds": "value",
                   "records_read": "k * 10", "result_rows": "k % 7", "physical_input_bytes": "(k + 1) * 4096"}),
        ("error", {**common,
                   "metric_id": f"benchmark_run_id || '__' || dataset || '_' || CAST(year AS VARCHAR) || '_' || {mm} || '__iceberg__' || 'silver.' || dataset || '_trips' || '__r' || lpad(CAST(repetition AS VARCHAR), 2, '0')",
                   "metric_type": "'iceberg_partition'", "table_name": "'silver.' || dataset || '_trips'",
                   "records_read": "k * 1000", "file_count": "k % 16 + 1", "data_size_bytes": "(k + 1) * 65536"}),
    ]
    selects = []
    for kind, cols in shapes:
        where = "event_type IN ('click', 'view')" if kind == "query" else f"event_type = '{kind}'"
        sel = ", ".join(f"CAST({cols.get(f.name, 'NULL')} AS {_DUCK[f.dataType.simpleString()]}) AS {f.name}"
                        for f in RUN_METRICS.fields)
        selects.append(f"SELECT {sel} FROM ub WHERE {where}")
    return f"""WITH ub AS (
  SELECT *, make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)) AS fin,
         'run-' || CAST(user_id AS VARCHAR) || '-' || architecture AS benchmark_run_id,
         'dag-' || CAST(event_id AS VARCHAR) AS dag_run_id,
         CASE WHEN user_id % 2 = 0 THEN 'green' ELSE 'yellow' END AS dataset,
         CASE WHEN user_id % 2 = 0 THEN 2014 ELSE 2011 END AS year,
         CAST((k % 4) * 3 + 1 AS INTEGER) AS month, CAST(k % 3 + 1 AS INTEGER) AS repetition
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CASE WHEN event_id % 2 = 0 THEN 'onprem' ELSE 'hybrid_aws' END AS architecture FROM events))
""" + " UNION ALL ".join(selects)


register("metric_union", _union_sql())(_metric_union)


def _gaps(spark, sf, dataset="yellow"):
    avail = _available(spark, sf, dataset)
    return ingest.partition_gaps(ingest.month_span(avail), avail)


register("partition_gaps", oracle.with_silver("""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(min(make_date(year, month, 1)), max(make_date(year, month, 1)), INTERVAL 1 MONTH)) AS d
      FROM silver_yellow)
WHERE (year(d), month(d)) NOT IN (SELECT (year, month) FROM silver_yellow)"""))(_gaps)
register("partition_gaps_both", _each_sql("""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(min(make_date(year, month, 1)), max(make_date(year, month, 1)), INTERVAL 1 MONTH)) AS d
      FROM {silver})
WHERE (year(d), month(d)) NOT IN (SELECT (year, month) FROM {silver})"""))(_each(_gaps))


def _pruned_scan(spark, sf, dataset="yellow"):
    target = work_path(spark, f"silver-scan-{dataset}")
    tables.overwrite_partitions(silver(spark, sf, dataset), target, SILVER_PARTITION_COLUMNS, order=["pickup_ts"],
                                following=following_columns(dataset))
    # Literal partition predicates -> PartitionFilters (only 1996 read).
    part = tables.read_partition(spark, target, [(1996, m) for m in range(1, 13)])
    out = marts.financial_aggregate(part, by=["year", "month"]).join(marts.row_count(part, by=["year", "month"]),
                                                                     ["year", "month"])
    return rnd(out.select(F.col("year").cast("int"), F.col("month").cast("int"), "row_count", "total_amount",
                          "avg_trip_distance", "avg_trip_duration_min"),
               {"total_amount": 2, "avg_trip_distance": 6, "avg_trip_duration_min": 6})


register("pruned_partition_scan", oracle.with_silver("""
SELECT year, month, count(*) AS row_count, round(sum(total_amount), 2) AS total_amount,
       round(avg(trip_distance), 6) AS avg_trip_distance, round(avg(trip_duration_min), 6) AS avg_trip_duration_min
FROM silver_yellow WHERE year = 1996 GROUP BY year, month"""))(_pruned_scan)
register("pruned_partition_scan_both", _each_sql("""
SELECT year, month, count(*) AS row_count, round(sum(total_amount), 2) AS total_amount,
       round(avg(trip_distance), 6) AS avg_trip_distance, round(avg(trip_duration_min), 6) AS avg_trip_duration_min
FROM {silver} WHERE year = 1996 GROUP BY year, month"""))(_each(_pruned_scan))
