"""Evidence analytics.

Range joins (task <-> application overlap, datapoints <-> request windows)
are turned into equi-joins on a time bucket: every interval is exploded
into the buckets it touches, points/intervals are joined on (key, bucket)
and the exact overlap predicate is applied after the join.  The fan-out is
bounded by interval length / bucket size, never by the number of rows, so
no nested-loop join appears at scale.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.scalar import parse_size, seconds_between
from tollgate.operators.sequence import latest_overlapping

# The eleven stage counters summed per application
# (output name -> stage field).
STAGE_COUNTERS = {
    "records_read": "inputRecords",
    "records_written": "outputRecords",
    "input_bytes": "inputBytes",
    "output_bytes": "outputBytes",
    "executor_run_time_ms": "executorRunTime",
    "memory_bytes_spilled": "memoryBytesSpilled",
    "disk_bytes_spilled": "diskBytesSpilled",
    "shuffle_read_bytes": "shuffleReadBytes",
    "shuffle_read_records": "shuffleReadRecords",
    "shuffle_write_bytes": "shuffleWriteBytes",
    "shuffle_write_records": "shuffleWriteRecords",
}

# Event-log accumulable names of the stage fields above.
ACCUMULABLES = {
    "inputRecords": ["internal.metrics.input.recordsRead"],
    "outputRecords": ["internal.metrics.output.recordsWritten"],
    "inputBytes": ["internal.metrics.input.bytesRead"],
    "outputBytes": ["internal.metrics.output.bytesWritten"],
    "executorRunTime": ["internal.metrics.executorRunTime"],
    "memoryBytesSpilled": ["internal.metrics.memoryBytesSpilled"],
    "diskBytesSpilled": ["internal.metrics.diskBytesSpilled"],
    "shuffleReadBytes": ["internal.metrics.shuffle.read.remoteBytesRead",
                         "internal.metrics.shuffle.read.localBytesRead"],
    "shuffleReadRecords": ["internal.metrics.shuffle.read.recordsRead"],
    "shuffleWriteBytes": ["internal.metrics.shuffle.write.bytesWritten"],
    "shuffleWriteRecords": ["internal.metrics.shuffle.write.recordsWritten"],
}


def app_counters(stages: DataFrame, app: str = "app_id") -> DataFrame:
    """Sum of the eleven counters over COMPLETE stages; NULL -> 0."""
    done = stages.where(F.col("status") == "COMPLETE")
    return done.groupBy(app).agg(*[
        F.sum(F.coalesce(F.col(src).cast("long"), F.lit(0))).alias(dst) for dst, src in STAGE_COUNTERS.items()
    ])


_ACC = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Value", T.StringType()),
])
_EVENT_SCHEMA = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("App ID", T.StringType()),
    T.StructField("App Name", T.StringType()),
    T.StructField("Stage Info", T.StructType([
        T.StructField("Stage ID", T.LongType()),
        T.StructField("Stage Attempt ID", T.LongType()),
        T.StructField("Failure Reason", T.StringType()),
        T.StructField("Accumulables", T.ArrayType(_ACC)),
    ])),
])


def read_event_log(spark, path: str) -> DataFrame:
    """Per-stage counters from Spark event logs (JSON lines).

    Stage status is COMPLETE unless the stage recorded a failure reason.
    The application id comes from the ApplicationStart event of the same
    log; the parts of a rolling log (folder ``eventlog_v2_*``) are one log.
    Returns (app_id, app_name, stage_id, attempt, status, <11
    stage fields>), ready for :func:`app_counters`.
    """
    raw = spark.read.schema(_EVENT_SCHEMA).option("recursiveFileLookup", "true").json(path).withColumn(
        "_file", F.regexp_replace(F.input_file_name(), r"(/eventlog_v2_[^/]*)/[^/]*$", "$1"))
    apps = raw.where(F.col("Event") == "SparkListenerApplicationStart").select(
        "_file", F.col("App ID").alias("app_id"), F.col("App Name").alias("app_name"))
    stages = raw.where(F.col("Event") == "SparkListenerStageCompleted").select(
        "_file",
        F.col("Stage Info.Stage ID").alias("stage_id"),
        F.col("Stage Info.Stage Attempt ID").alias("attempt"),
        F.when(F.col("Stage Info.Failure Reason").isNull(), F.lit("COMPLETE")).otherwise(F.lit("FAILED")).alias("status"),
        F.coalesce(F.col("Stage Info.Accumulables"), F.array().cast(T.ArrayType(_ACC))).alias("_acc"),
    )

    def counter(name):
        # Other names may repeat within a stage (SQL metrics); only the wanted one is looked at.
        return F.get(F.filter("_acc", lambda a: a["Name"] == name), F.lit(0))["Value"].try_cast("long")

    def field(names):
        found = [counter(n) for n in names]
        return found[0] if len(found) == 1 else F.when(
            F.coalesce(*found).isNotNull(), sum((F.coalesce(v, F.lit(0)) for v in found), F.lit(0).cast("long")))

    # One application per log; the join strategy is left to AQE (the
    # number of logs is not bounded a priori).
    return stages.join(apps, "_file", "left").select(
        "app_id", "app_name", "stage_id", "attempt", "status",
        *[field(n).alias(f) for f, n in ACCUMULABLES.items()],
    )


# ---------------------------------------------------------------------------
# bucketed interval joins
# ---------------------------------------------------------------------------

def _buckets(start: Column, end: Column, seconds: int) -> Column:
    lo = F.floor(F.unix_seconds(start) / seconds)
    hi = F.floor(F.unix_seconds(end) / seconds)
    return F.explode(F.sequence(lo, F.greatest(lo, hi)))


def points_in_windows(points: DataFrame, windows: DataFrame, before_seconds: int = 60,
                      after_seconds: int = 120, bucket_seconds: int = 3600) -> DataFrame:
    """Datapoints inside ``[start - before, end + after]`` of each window.

    ``points``: (target, metric, ts, value); ``windows``: (block, start, end).
    Returns (block, target, metric, ts, value).
    """
    w = windows.select(
        "block",
        (F.col("start") - F.make_interval(secs=F.lit(before_seconds))).alias("_lo"),
        (F.col("end") + F.make_interval(secs=F.lit(after_seconds))).alias("_hi"),
    )
    wb = w.select("*", _buckets(F.col("_lo"), F.col("_hi"), bucket_seconds).alias("_b"))
    pb = points.withColumn("_b", F.floor(F.unix_seconds("ts") / bucket_seconds))
    return (
        pb.join(wb, "_b", "inner")
        .where((F.col("ts") >= F.col("_lo")) & (F.col("ts") <= F.col("_hi")))
        .select("block", "target", "metric", "ts", "value")
    )


_MINUTE = 60_000_000


def _minute(micros: Column) -> Column:
    """Number of the minute that holds a time in microseconds, in whole numbers."""
    return ((micros - F.pmod(micros, F.lit(_MINUTE))) / _MINUTE).cast("long")


def totals_in_windows(points: DataFrame, windows: DataFrame, before_seconds: int = 60, after_seconds: int = 120) -> DataFrame:
    """(block, metric, total, datapoints) of each window, without a row for each point and window.

    A time index of two levels: the minutes that lie whole in ``[start -
    before, end + after]`` are taken from sums per metric and minute, computed
    once for all windows; only points of the window's two edge minutes are
    compared with its bounds.  A NULL value counts as a datapoint of 0; a
    window with a NULL bound holds nothing.  Decimal values give exact totals.
    """
    w = windows.select(
        "block", (F.unix_micros(F.col("start").cast("timestamp")) - before_seconds * 1_000_000).alias("_lo"),
        (F.unix_micros(F.col("end").cast("timestamp")) + after_seconds * 1_000_000).alias("_hi"),
    ).where(F.col("_lo") <= F.col("_hi")).withColumns({
        "_first": _minute(F.col("_lo") + (_MINUTE - 1)), "_last": _minute(F.col("_hi") + 1) - 1})
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    p = points.select("metric", F.coalesce(F.col("value"), F.lit(0)).alias("_v"), at.alias("_at"), _minute(at).alias("_m"))
    minutes = p.groupBy("metric", "_m").agg(F.sum("_v").alias("total"), F.count(F.lit(1)).alias("datapoints"))
    whole = (w.where(F.col("_first") <= F.col("_last"))
             .select("block", F.explode(F.sequence("_first", "_last")).alias("_m"))
             .join(minutes, "_m").select("block", "metric", "total", "datapoints"))
    edges = F.filter(F.array_distinct(F.array(_minute(F.col("_lo")), _minute(F.col("_hi")))),
                     lambda m: (m < F.col("_first")) | (m > F.col("_last")))
    edge = (w.select("block", "_lo", "_hi", F.explode(edges).alias("_m")).join(p, "_m")
            .where(F.col("_at").between(F.col("_lo"), F.col("_hi")))
            .groupBy("block", "metric").agg(F.sum("_v").alias("total"), F.count(F.lit(1)).alias("datapoints")))
    return whole.unionByName(edge).groupBy("block", "metric").agg(
        F.sum("total").alias("total"), F.sum("datapoints").alias("datapoints"))


def window_completeness(windows: DataFrame, matched: DataFrame) -> DataFrame:
    """A window is complete iff it has at least one datapoint.

    ``matched``: datapoints in windows, or their totals."""
    count = F.sum("datapoints") if "datapoints" in matched.columns else F.count(F.lit(1))
    n = matched.groupBy("block").agg(count.alias("datapoints"))
    return windows.select("block").join(n, "block", "left").select(
        "block", F.coalesce("datapoints", F.lit(0)).alias("datapoints"),
        (F.coalesce("datapoints", F.lit(0)) > 0).alias("complete"))


def request_totals(points: DataFrame) -> DataFrame:
    """Total of every request metric; a missing Sum counts as 0.

    ``points``: datapoints, or totals per window."""
    value = "total" if "total" in points.columns else "value"
    return points.groupBy("metric").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("total"))


def match_applications(tasks: DataFrame, apps: DataFrame, partitions: int | None = None) -> DataFrame:
    """The application of each task (same name, overlapping time).

    Overlap: ``app_end >= task_start and app_start <= task_end``, a NULL
    bound on either side is permissive.  Among candidates the one with the
    latest start wins (ties: larger app id).  Tasks without a candidate or
    name get a NULL ``app_id``; repeated tasks give repeated rows.  Inputs:
    tasks (task_key, name, started_at, finished_at), apps (app_id, name,
    start, end).  Running applications (NULL end) need no join on the name
    alone: see ``latest_overlapping``.
    """
    t = tasks.select("task_key", "name", "started_at", "finished_at")
    a = apps.select("app_id", "name", "start", "end")
    out = latest_overlapping(a, t, ["name"], "start", "end", "started_at", "finished_at", "app_id", "app_id", partitions)
    return out.select("task_key", "name", "app_id", F.col("app_id").isNotNull().alias("matched"))


# ---------------------------------------------------------------------------
# price list and cost (F9, J11, U4), resources
# ---------------------------------------------------------------------------

_DIM = T.StructType([
    T.StructField("description", T.StringType()), T.StructField("unit", T.StringType()),
    T.StructField("beginRange", T.StringType()), T.StructField("endRange", T.StringType()),
    T.StructField("pricePerUnit", T.StructType([T.StructField("USD", T.StringType())])),
])
OFFER_SCHEMA = T.StructType([
    T.StructField("serviceCode", T.StringType()),
    T.StructField("product", T.StructType([
        T.StructField("productFamily", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ])),
    T.StructField("terms", T.StructType([
        T.StructField("OnDemand", T.MapType(T.StringType(), T.StructType([
            T.StructField("priceDimensions", T.MapType(T.StringType(), _DIM)),
        ]))),
    ])),
])

# Price-list predicates of the three billed rates.
GET_GROUP = ("S3-API-Tier2", "GET and all other requests")
PUT_GROUP = ("S3-API-Tier1", "PUT/COPY/POST or LIST requests")
TRANSFER = {"serviceCode": "AWSDataTransfer", "productFamily": "Data Transfer", "unit": "gb",
            "description": "data transfer out", "fromRegionCode": "us-east-1",
            "transferType": "AWS Outbound", "toLocation": "External"}
# Usage metric -> rate name.
USAGE_RATES = {"GetRequests": "get_requests", "PutRequests": "put_requests", "BytesDownloaded": "bytes_downloaded"}


def price_rates(offers: DataFrame, offer_col: str = "offer", order_col: str = "offer_id") -> DataFrame:
    """(rate_name, usd, unit, description, begin_range, end_range).

    Offers are JSON strings.  When several dimensions match a rate, the
    last one in list order (``order_col``, then term/dimension key) wins.
    """
    parsed = offers.select(F.col(order_col).alias("_ord"), F.from_json(offer_col, OFFER_SCHEMA).alias("o"))
    attrs = F.col("o.product.attributes")
    terms = parsed.select(
        "_ord",
        F.coalesce(F.col("o.serviceCode"), F.try_element_at(attrs, F.lit("servicecode")), F.lit("")).alias("service"),
        F.coalesce(F.try_element_at(attrs, F.lit("group")), F.lit("")).alias("grp"),
        F.coalesce(F.try_element_at(attrs, F.lit("groupDescription")), F.lit("")).alias("gdesc"),
        F.coalesce(F.col("o.product.productFamily"), F.lit("")).alias("family"),
        F.coalesce(F.try_element_at(attrs, F.lit("fromRegionCode")), F.lit("")).alias("from_region"),
        F.coalesce(F.try_element_at(attrs, F.lit("transferType")), F.lit("")).alias("transfer_type"),
        F.coalesce(F.try_element_at(attrs, F.lit("toLocation")), F.lit("")).alias("to_location"),
        F.explode_outer(F.col("o.terms.OnDemand")).alias("term_key", "term"),
    )
    dims = terms.select("*", F.explode_outer(F.col("term.priceDimensions")).alias("dim_key", "d")).where(
        F.col("d.pricePerUnit.USD").isNotNull() & (F.col("d.pricePerUnit.USD") != ""))
    desc = F.lower(F.coalesce(F.col("d.description"), F.lit("")))
    unit = F.coalesce(F.col("d.unit"), F.lit(""))
    is_get = (F.col("grp") == GET_GROUP[0]) & (F.col("gdesc") == GET_GROUP[1])
    is_put = (F.col("grp") == PUT_GROUP[0]) & (F.col("gdesc") == PUT_GROUP[1])
    is_out = ((F.col("service") == TRANSFER["serviceCode"]) & (F.col("family") == TRANSFER["productFamily"])
              & (F.lower(unit) == TRANSFER["unit"]) & desc.contains(TRANSFER["description"])
              & (F.col("from_region") == TRANSFER["fromRegionCode"])
              & (F.col("transfer_type") == TRANSFER["transferType"])
              & (F.col("to_location") == TRANSFER["toLocation"])
              & (F.coalesce(F.col("d.beginRange").try_cast("double"), F.lit(-1.0)) == 0))
    tagged = dims.select(
        F.explode(F.filter(F.array(
            F.when(is_get, F.lit("get_requests")), F.when(is_put, F.lit("put_requests")),
            F.when(is_out, F.lit("bytes_downloaded"))), lambda x: x.isNotNull())).alias("rate_name"),
        "_ord", "term_key", "dim_key",
        F.col("d.pricePerUnit.USD").cast("double").alias("usd"), unit.alias("unit"), desc.alias("description"),
        F.coalesce(F.col("d.beginRange"), F.lit("")).alias("begin_range"),
        F.coalesce(F.col("d.endRange"), F.lit("")).alias("end_range"),
    )
    order = F.struct("_ord", "term_key", "dim_key")
    return tagged.groupBy("rate_name").agg(*[
        F.max_by(c, order).alias(c) for c in ("usd", "unit", "description", "begin_range", "end_range")
    ])


def cost_estimate(usage: DataFrame, rates: DataFrame,
                  mapping: Mapping[str, str] = USAGE_RATES) -> DataFrame:
    """Billable quantity x USD per usage metric; absent rates are flagged.

    Bytes are billed per GiB, units mentioning 1k / 1,000 per thousand,
    everything else as is.  A metric without usage is a row of quantity 0.
    Rows with ``missing_rate`` carry no cost.
    """
    names = usage.sparkSession.createDataFrame(list(mapping.items()), "metric string, rate_name string")
    used = usage.select("metric", F.col("quantity").cast("double").alias("quantity"))
    # The mapping is a handful of rows; rates have at most one row per rate name.
    j = names.join(used, "metric", "left").na.fill(0.0, ["quantity"]).join(rates, "rate_name", "left")
    unit = F.lower(F.coalesce(F.col("unit"), F.lit("")))
    billable = (F.when(F.col("metric") == "BytesDownloaded", F.col("quantity") / float(1024**3))
                .when(unit.contains("1k") | unit.contains("1,000"), F.col("quantity") / 1000)
                .otherwise(F.col("quantity")))
    return j.select(
        "metric", "rate_name", "quantity", billable.alias("billable_quantity"), "usd", "unit",
        (billable * F.col("usd")).alias("estimated_usd"), F.col("usd").isNull().alias("missing_rate"),
    )


def cost_total(cost: DataFrame) -> DataFrame:
    """One row with the summed estimate and the sorted names of the missing rates.

    The list is as long as the mapping of :func:`cost_estimate` at most."""
    missing = F.sort_array(F.collect_set(F.when(F.col("missing_rate"), F.col("rate_name"))))
    return cost.agg(F.coalesce(F.sum("estimated_usd"), F.lit(0.0)).alias("estimated_usd"), missing.alias("missing_rates"))


def resource_summary(samples: DataFrame, members: DataFrame, capacity: DataFrame | None = None,
                     default_interval: float = 5.0) -> DataFrame:
    """Integrated resource use per architecture.

    ``samples``: (benchmark_run_id, cpu_percent, memory, interval_seconds?)
    where memory is bytes or a size string (F5); ``members``: accepted
    members (benchmark_run_id, architecture, started_at, finished_at);
    ``capacity``: (benchmark_run_id, cpu_cores, memory_gib).
    cpu_seconds = sum(cpu% / 100 * dt); memory_gib_hours = sum(bytes / GiB *
    dt / 3600); configured_* = capacity x member hours.
    """
    interval = (F.coalesce(F.col("interval_seconds").cast("double"), F.lit(default_interval))
                if "interval_seconds" in samples.columns else F.lit(default_interval))
    mem = F.col("memory")
    mem_bytes = parse_size(mem) if dict(samples.dtypes)["memory"] == "string" else mem.cast("double")
    s = samples.select("benchmark_run_id", F.col("cpu_percent").cast("double").alias("_cpu"),
                       mem_bytes.alias("_mem"), interval.alias("_dt"))
    mem_ = members.select("benchmark_run_id", "architecture", "started_at", "finished_at").dropDuplicates(["benchmark_run_id"])
    used = s.join(mem_.select("benchmark_run_id", "architecture"), "benchmark_run_id", "inner").groupBy("architecture").agg(
        F.sum(F.col("_cpu") / 100.0 * F.col("_dt")).alias("cpu_seconds"),
        F.sum(F.col("_mem") / float(1024**3) * F.col("_dt") / 3600).alias("memory_gib_hours"),
    )
    if capacity is None:
        return used
    hours = seconds_between(F.col("started_at"), F.col("finished_at")) / 3600
    conf = mem_.where(F.col("started_at").isNotNull() & F.col("finished_at").isNotNull()) \
        .join(capacity, "benchmark_run_id", "inner").groupBy("architecture").agg(
            F.sum(F.col("cpu_cores") * hours).alias("configured_cpu_hours"),
            F.sum(F.col("memory_gib") * hours).alias("configured_memory_gib_hours"),
        )
    return used.join(conf, "architecture", "full_outer")
