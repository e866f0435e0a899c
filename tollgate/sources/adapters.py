"""Adapters from the driver's tables to the shapes the operators consume.

There is no taxi or benchmark data here, so raw monthly trip files and run
metrics are *derived by Spark* from the given tables; every derived frame
grows with its source table, and each has an equivalent SQL text in
``tollgate.plans.oracle`` for the DuckDB cross-check.

* raw trips     <- lineitem JOIN orders on the order key
* run metrics   <- events (one event = one measured metric row)
* price offers  <- part (one part = one price dimension of an offer)
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.schemas import RUN_METRICS
from tollgate.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# raw trips
# ---------------------------------------------------------------------------

def _trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # Both sides are large at scale: a shuffled equi-join on the order key
    # (AQE may still switch to broadcast when orders turns out small).
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").withColumn(
        "dataset", F.when(F.col("l_orderkey") % 2 == 0, F.lit("green")).otherwise(F.lit("yellow")))


def _raw_trip_base(lines: DataFrame) -> DataFrame:
    fare = F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 2),
        -F.col("l_extendedprice"),
    ).otherwise(F.col("l_extendedprice"))
    return lines.select(
        "dataset",
        (F.col("l_suppkey") % 3).alias("vendor"),
        F.col("o_orderdate").alias("pickup"),
        F.col("l_shipdate").alias("dropoff"),
        F.col("l_linenumber").cast("bigint").alias("passengers"),
        F.col("l_quantity").alias("distance"),
        (F.col("l_linenumber") % 6 + 1).cast("bigint").alias("ratecode"),
        F.when(F.col("l_returnflag") == "A", F.lit("Y"))
        .when(F.col("l_returnflag") == "N", F.lit("N"))
        .alias("flag"),
        F.col("l_suppkey").alias("pu"),
        (F.col("l_partkey") % 265 + 1).alias("do"),
        (F.col("l_linenumber") % 4 + 1).cast("bigint").alias("payment"),
        fare.alias("fare"),
        (fare * F.col("l_discount")).alias("tip"),
        (fare * F.col("l_tax")).alias("tolls"),
    ).withColumn("total", F.col("fare") + F.col("tip") + F.col("tolls"))


def _raw_columns(dataset: str) -> list[Column]:
    pickup, dropoff = (
        ("tpep_pickup_datetime", "tpep_dropoff_datetime")
        if dataset == "yellow"
        else ("lpep_pickup_datetime", "lpep_dropoff_datetime")
    )
    return [
        F.col("vendor").alias("VendorID"),
        F.col("pickup").alias(pickup),
        F.col("dropoff").alias(dropoff),
        F.col("passengers").alias("passenger_count"),
        F.col("distance").alias("trip_distance"),
        F.col("ratecode").alias("RatecodeID"),
        F.col("flag").alias("store_and_fwd_flag"),
        F.col("pu").alias("PULocationID"),
        F.col("do").alias("DOLocationID"),
        F.col("payment").alias("payment_type"),
        F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"),
        F.col("tolls").alias("tolls_amount"),
        F.col("total").alias("total_amount"),
    ]


def raw_trips(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Raw-file-shaped trips of one dataset (source column names).

    Optional money columns (extra, mta_tax, ...) are absent on purpose: the
    normalizer must fill them with typed NULLs.
    """
    base = _raw_trip_base(_trip_lines(spark, sf_dir))
    return base.where(F.col("dataset") == dataset).select(*_raw_columns(dataset))


@contextmanager
def staged_raw_trips(spark: SparkSession, sf_dir: str, dataset: str) -> Iterator[DataFrame]:
    """:func:`raw_trips` for a job that reads them more than once.

    The join is made once and kept, with the columns of the given tables, as
    plain files on the shared folder until the job is done with them.
    """
    lines = _trip_lines(spark, sf_dir).where(F.col("dataset") == dataset).drop("l_orderkey", "o_orderkey")
    staged = work_path(spark, f"trip-lines-{dataset}")
    try:
        lines.write.option("compression", "zstd").parquet(staged)
        yield _raw_trip_base(spark.read.schema(lines.schema).parquet(staged)).select(*_raw_columns(dataset))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def raw_trips_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {ds: raw_trips(spark, sf_dir, ds) for ds in ("yellow", "green")}


# ---------------------------------------------------------------------------
# run metrics
# ---------------------------------------------------------------------------

# Mapping of event types onto metric types.
EVENT_METRIC_TYPE = {
    "purchase": "pipeline",
    "signup": "airflow_task",
    "click": "trino_query",
    "view": "trino_query",
    "error": "iceberg_partition",
}
# Query names of the filtered and the broad scan.
FILTERED_QUERY = "01_partition_financial_aggregation"
BROAD_QUERY = "03_dataset_financial_scan"
EVENT_QUERY_NAME = {"click": FILTERED_QUERY, "view": BROAD_QUERY}
# Measurement protocols and the task ids of the pipeline DAG.
PROTOCOLS = ("pipeline_paired", "warm_recorded", "service_cold_recorded")
TASK_IDS = ("stage_trips", "check_silver_quality", "build_gold_revenue")


def _pick(values, index: Column) -> Column:
    """values[index] for a 0-based integer Column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """56-column run-metrics rows derived from ``events``.

    One event is one measured metric: architecture = parity of event_id,
    architecture pair = user_id (``dag_run_id``), 2x2 layout block = two
    users (``trial_id``; layout = parity of user_id), metric type / query
    from event_type, duration = value, started_at = ts, counters from
    ``props.k``.
    """
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    arch = F.when(F.col("event_id") % 2 == 0, F.lit("onprem")).otherwise(F.lit("hybrid_aws"))
    mtype = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(m)) for t, m in EVENT_METRIC_TYPE.items()])
    staged = ev.select(
        "event_id", "user_id", "event_type", "value",
        F.to_timestamp("ts").alias("ts"), k.alias("k"), arch.alias("arch"),
        mtype.alias("mtype"), F.expr("user_id div 2").alias("block"),
    ).select(
        "*", _pick(PROTOCOLS, F.col("block") % 3).alias("protocol"),
        F.when(F.col("block") % 2 == 0, F.lit("green")).otherwise(F.lit("yellow")).alias("ds"),
    ).withColumn("run_id", F.concat(F.lit("run-"), _s("user_id"), F.lit("-"), F.col("arch")))
    qname = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(q)) for t, q in EVENT_QUERY_NAME.items()])
    cols = {
        "benchmark_run_id": F.col("run_id"),
        "comparison_id": F.lit("cmp-events"),
        "trial_id": F.concat(F.lit("trial-"), _s("block")),
        "sequence_position": F.col("event_id") + 1,
        "measurement_protocol": F.col("protocol"),
        "retry_count": F.col("k") % 2,
        "metric_id": F.concat(F.col("run_id"), F.lit(":"), _s("event_id")),
        "metric_type": F.col("mtype"),
        "architecture": F.col("arch"),
        "environment": F.when(F.col("arch") == "onprem", F.lit("local")).otherwise(F.lit("aws")),
        "file_layout": F.when(F.col("user_id") % 2 == 0, F.lit("fragmented")).otherwise(F.lit("compact")),
        "workload_name": F.lit("events"),
        "dag_id": F.lit("trip_pipeline"),
        "dag_run_id": F.concat(F.lit("dag-"), _s("user_id")),
        "task_id": F.when(F.col("mtype") == "airflow_task", _pick(TASK_IDS, F.col("k") % 3)),
        "query_name": qname,
        "query_id": F.when(F.col("mtype") == "trino_query",
                           F.concat(F.lit("q"), _s("user_id"), F.lit("-"), _s("k"))),
        "dataset": F.col("ds"),
        "year": F.when(F.col("ds") == "green", F.lit(2014)).otherwise(F.lit(2011)),
        "month": (F.col("k") % 4) * 3 + 1,
        "repetition": F.col("k") % 3 + 1,
        "status": F.when(F.col("value") < 1.0, F.lit("FAILED"))
        .when(F.col("mtype") == "trino_query", F.lit("FINISHED"))
        .otherwise(F.lit("success")),
        "started_at": F.col("ts"),
        "finished_at": F.timestamp_micros(
            F.unix_micros("ts") + F.round(F.col("value") * 1_000_000).cast("bigint")),
        "duration_seconds": F.col("value"),
        "physical_input_bytes": (F.col("k") + 1) * 4096,
        "records_read": F.col("k") * 1000,
        "file_count": F.col("k") % 16 + 1,
        "data_size_bytes": (F.col("k") + 1) * 65536,
        "spark_application_id": F.when(
            F.col("mtype") == "airflow_task",
            F.concat(F.lit("app-"), _s("user_id"), F.lit("-"), _s(F.col("k") % 3))),
        "table_name": F.when(F.col("mtype") == "iceberg_partition",
                             F.concat(F.lit("silver."), F.col("ds"), F.lit("_trips"))),
        "cache_state": F.when(F.col("protocol") == "warm_recorded", F.lit("warm")).otherwise(F.lit("cold")),
        "processed_at": F.col("ts"),
    }
    return staged.select(*[
        (cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RUN_METRICS.fields
    ])


# ---------------------------------------------------------------------------
# price offers
# ---------------------------------------------------------------------------

# Offer kinds (p_size % 4) -> product attributes.
OFFER_KINDS = {
    0: ("AmazonS3", "API Request", {"group": "S3-API-Tier1", "groupDescription": "PUT/COPY/POST or LIST requests"},
        "Requests", "USD per PUT, COPY, POST, or LIST requests"),
    1: ("AmazonS3", "API Request", {"group": "S3-API-Tier2", "groupDescription": "GET and all other requests"},
        "Requests", "USD per GET and all other requests"),
    2: ("AWSDataTransfer", "Data Transfer", {"fromRegionCode": "us-east-1", "transferType": "AWS Outbound",
                                             "toLocation": "External"},
        "GB", "USD per GB - data transfer out to the internet"),
    3: ("AmazonS3", "Storage", {"group": "Other"}, "GB-Mo", "USD per GB-month of storage"),
}


def price_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price-list offers as JSON strings, one per ``part`` row.

    The kind (PUT / GET / transfer / other) comes from ``p_size % 4``; the
    price per unit is ``p_retailprice / 1e9``; transfer offers of odd
    ``p_size // 4`` start at a higher tier (beginRange 10240).
    """
    part = table(spark, sf_dir, "part")
    kind = F.col("p_size") % 4

    service = F.coalesce(*[F.when(kind == k, F.lit(v[0])) for k, v in OFFER_KINDS.items()])
    family = F.coalesce(*[F.when(kind == k, F.lit(v[1])) for k, v in OFFER_KINDS.items()])
    attrs = F.coalesce(*[F.when(kind == k, F.create_map(*[x for a, b in v[2].items() for x in (F.lit(a), F.lit(b))]))
                         for k, v in OFFER_KINDS.items()])
    unit = F.coalesce(*[F.when(kind == k, F.lit(v[3])) for k, v in OFFER_KINDS.items()])
    desc = F.coalesce(*[F.when(kind == k, F.lit(v[4])) for k, v in OFFER_KINDS.items()])
    begin = F.when((kind == 2) & (F.expr("p_size div 4") % 2 == 1), F.lit("10240")).otherwise(F.lit("0"))
    usd = (F.col("p_retailprice") / 1e9).cast("string")
    dim = F.struct(desc.alias("description"), unit.alias("unit"), begin.alias("beginRange"),
                   F.lit("Inf").alias("endRange"), F.struct(usd.alias("USD")).alias("pricePerUnit"))
    offer = F.to_json(F.struct(
        service.alias("serviceCode"),
        F.struct(family.alias("productFamily"), attrs.alias("attributes")).alias("product"),
        F.struct(F.create_map(
            F.concat(F.lit("term"), F.col("p_partkey").cast("string")),
            F.struct(F.create_map(F.concat(F.lit("dim"), F.col("p_partkey").cast("string")), dim).alias("priceDimensions")),
        ).alias("OnDemand")).alias("terms"),
    ))
    return part.select(F.col("p_partkey").alias("offer_id"), (kind == 2).alias("is_transfer"), offer.alias("offer"))


# ---------------------------------------------------------------------------
# evidence shapes derived from events
# ---------------------------------------------------------------------------

# Request metric reported for each event type.
EVENT_REQUEST_METRIC = {
    "click": "GetRequests", "view": "GetRequests", "purchase": "PutRequests",
    "signup": "PutRequests", "error": "BytesDownloaded",
}


def request_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request datapoints (target, metric, ts, value) from ``events``."""
    ev = table(spark, sf_dir, "events")
    metric = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(m)) for t, m in EVENT_REQUEST_METRIC.items()])
    return ev.select(
        F.concat(F.lit("bucket-"), (F.col("user_id") % 4).cast("string")).alias("target"),
        metric.alias("metric"), F.to_timestamp("ts").alias("ts"),
        F.when(F.col("event_type") == "error", F.col("value") * 1048576).otherwise(F.col("value")).alias("value"),
    )


def request_windows(metrics: DataFrame) -> DataFrame:
    """Evidence windows: one per (protocol, day) of the run metrics."""
    return metrics.groupBy(
        F.concat(F.col("measurement_protocol"), F.lit(":"), F.to_date("started_at").cast("string")).alias("block")
    ).agg(F.min("started_at").alias("start"), F.max("finished_at").alias("end"))


def resource_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container samples (benchmark_run_id, cpu_percent, memory text) from ``events``."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    arch = F.when(F.col("event_id") % 2 == 0, F.lit("onprem")).otherwise(F.lit("hybrid_aws"))
    mem = (F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit("MiB")))
           .when(k % 3 == 1, F.concat((k / 10.0).cast("string"), F.lit(" GiB")))
           .otherwise(F.concat((k * 1024).cast("string"), F.lit("B"))))
    return ev.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string"), F.lit("-"), arch).alias("benchmark_run_id"),
        (F.col("value") / 5).alias("cpu_percent"), mem.alias("memory"),
        F.lit(5.0).alias("interval_seconds"),
    )


def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage-level counters (one stage per event) for application counters."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    fields = ["inputRecords", "outputRecords", "inputBytes", "outputBytes", "executorRunTime",
              "memoryBytesSpilled", "diskBytesSpilled", "shuffleReadBytes", "shuffleReadRecords",
              "shuffleWriteBytes", "shuffleWriteRecords"]
    return ev.select(
        F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("app_id"),
        F.col("event_id").alias("stage_id"),
        F.when(F.col("value") < 1.0, F.lit("FAILED")).otherwise(F.lit("COMPLETE")).alias("status"),
        *[F.when(k % (i + 2) != 0, k * (i + 1)).alias(f) for i, f in enumerate(fields)],
    )
