"""File-level sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.sources.drift import file_schemas, read_drifting


def month_paths(base: str, dataset: str, parts: Sequence[tuple[int, int]]) -> list[str]:
    """``{base}/{year}/{dataset}_tripdata_{year}-{MM}.parquet`` per month."""
    return [f"{base.rstrip('/')}/{y}/{dataset}_tripdata_{y}-{int(m):02d}.parquet" for y, m in parts]


def stored(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


# What errors of reading files say, in Spark's error classes and those of the stores.
_READ_ERRORS = re.compile("FAILED_READ_FILE|CANNOT_READ_FILE|UNABLE_TO_INFER_SCHEMA|PATH_NOT_FOUND|TABLE_OR_VIEW_NOT_FOUND|FileNotFoundException"
                          "|is not a Parquet file|org.apache.parquet.io.ParquetDecodingException")


def is_read_error(error: BaseException) -> bool:
    """Whether a job failed on its files, rather than on lost executors, memory or code."""
    return isinstance(error, OSError) or bool(_READ_ERRORS.search(str(error)))


def month_inventory(spark: SparkSession, base: str, dataset: str, parts: Sequence[tuple[int, int]]) -> DataFrame:
    """(dataset, year, month, path, status, error) of every requested month.

    ``status`` is ``present``, ``missing`` (no file: the incremental loop passes
    over it, I2) or ``unreadable`` (a file whose footer can't be read).
    """
    return _inventory_rows(spark, dataset, _month_files(spark, base, dataset, parts))


def _month_files(spark: SparkSession, base: str, dataset: str, parts: Sequence[tuple[int, int]]) -> list[tuple]:
    """(year, month, path, status, error, {file: signature}) of every requested month."""
    wanted = [(int(y), int(m), p) for (y, m), p in zip(parts, month_paths(base, dataset, parts))]
    present = {p for *_, p in wanted if stored(spark, p)}
    found = file_schemas(spark, sorted(present)) if present else []
    root = _qualified(spark, base)
    out = []
    for year, month, path in wanted:
        place = root + path[len(base.rstrip("/")):]
        own = [f for f in found if f[0] == place or f[0].startswith(place + "/")]
        errors = [f[2] for f in own if f[2]]
        status = "missing" if path not in present or not own else "unreadable" if errors else "present"
        out.append((year, month, path, status, errors[0] if errors else None, {f[0]: f[1] for f in own if f[1]}))
    return out


def _qualified(spark: SparkSession, base: str) -> str:
    """``base`` with its scheme, as file listings name it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base.rstrip("/"))
    return str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())


def _inventory_rows(spark: SparkSession, dataset: str, months: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame([(dataset, *m[:5]) for m in months],
                                 "dataset string, year int, month int, path string, status string, error string")


def scan_months(spark: SparkSession, base: str, dataset: str, parts: Sequence[tuple[int, int]]) -> tuple[DataFrame | None, DataFrame]:
    """The rows of the present months (None without any), and the inventory of all requested ones.

    Rows carry ``file_year`` and ``file_month`` of their file (P11 compares them
    with the pickup).  File types may drift from month to month.
    """
    months = _month_files(spark, base, dataset, parts)
    good = {f: s for *_, status, _, own in months if status == "present" for f, s in own.items()}
    inventory = _inventory_rows(spark, dataset, months)
    if not good:
        return None, inventory
    name = F.regexp_extract("_metadata.file_path", rf"{dataset}_tripdata_(\d{{4}})-(\d{{2}})\.parquet", 0)
    return read_drifting(spark, good, {"file_year": F.substring(name, len(dataset) + 11, 4).cast("int"),
                                       "file_month": F.substring(name, len(dataset) + 16, 2).cast("int")}), inventory


def scan_month_files(spark: SparkSession, base: str, dataset: str,
                     parts: Sequence[tuple[int, int]], missing_ok: bool = True) -> DataFrame:
    """The rows of the monthly raw files of one dataset.

    Missing or unreadable months raise unless ``missing_ok``; :func:`scan_months`
    returns them as rows.  Case variants of a name are one column.
    """
    rows, inventory = scan_months(spark, base, dataset, parts)
    lost = [f"{r.year}-{r.month:02d} ({r.status})" for r in inventory.where("status <> 'present'").collect()]
    if rows is None or lost and not missing_ok:
        raise FileNotFoundError(f"No raw files for {dataset}: {', '.join(lost)}")
    return rows.drop("file_year", "file_month")


def scan_glob(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Every parquet file under ``directory`` matching ``pattern``, whose types may drift."""
    found = file_schemas(spark, [directory], pattern)
    bad = [(path, error) for path, _, error in found if error]
    if bad:
        raise OSError(f"{len(bad)} files can't be read, first {bad[0][0]}: {bad[0][1]}")
    return read_drifting(spark, {path: signature for path, signature, _ in found})


def land_raw(df: DataFrame, base: str, part_cols: Sequence[str] = ("year", "month")) -> None:
    """Write raw trips as a month-partitioned landing zone.

    Clustered with the ``rebalance`` hint: few files per month, and a hot
    month is split over several tasks/files (the incremental ingest rebuilds
    a month from all its files).
    """
    from tollgate.sources.tables import clustered_for_write

    clustered_for_write(df, part_cols).write.mode("overwrite").partitionBy(*part_cols).parquet(base)


def checksum_manifest(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, size_bytes, sha256) for every file under ``path``.

    Uses the ``binaryFile`` source: each file is read whole by one task, so
    this suits object-sized files (the table files here); larger objects
    should be checksummed by the storage layer.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("length").alias("size_bytes"), F.sha2(F.col("content"), 256).alias("sha256")))


def relative(manifest: DataFrame, root: str) -> DataFrame:
    """Manifest keyed by path relative to ``root`` (scheme-insensitive)."""
    r = root.rstrip("/").split(":", 1)[-1]
    return manifest.withColumn("key", F.regexp_replace(F.regexp_replace("path", "^file:", ""), "^" + r + "/?", ""))


def compare_manifests(recorded: DataFrame, observed: DataFrame, key: str = "key") -> DataFrame:
    """Objects whose size or digest differ, or that are missing on one side."""
    r = recorded.select(key, F.col("size_bytes").alias("recorded_size"), F.col("sha256").alias("recorded_sha256"))
    o = observed.select(key, F.col("size_bytes").alias("observed_size"), F.col("sha256").alias("observed_sha256"))
    j = r.join(o, key, "full_outer")
    reason = (F.when(F.col("observed_size").isNull(), F.lit("missing_observed"))
              .when(F.col("recorded_size").isNull(), F.lit("unexpected_observed"))
              .when(F.col("recorded_size") != F.col("observed_size"), F.lit("size_mismatch"))
              .when(F.col("recorded_sha256") != F.col("observed_sha256"), F.lit("digest_mismatch")))
    return j.withColumn("mismatch", reason).where(F.col("mismatch").isNotNull())


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write all rows with columns in sorted name order (header for csv)."""
    out = df.select(*sorted(df.columns))
    if fmt == "csv":
        out.write.mode("overwrite").option("header", "true").csv(path)
    elif fmt == "json":
        out.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"Unsupported export format: {fmt}")


# Run artifact JSON: {benchmark_run_id, metrics[], query_results[], dag_results[]}.
_QUERY_RESULT = T.StructType([
    T.StructField("query_name", T.StringType()),
    T.StructField("partition", T.StructType([
        T.StructField("dataset", T.StringType()), T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType())])),
    T.StructField("result", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("row_count", T.LongType()), T.StructField("state", T.StringType()),
        T.StructField("error", T.StringType())])),
])
ARTIFACT_SCHEMA = T.StructType([
    T.StructField("benchmark_run_id", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("metrics", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("query_results", T.ArrayType(_QUERY_RESULT)),
    T.StructField("dag_results", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])


def read_run_artifacts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Nested run artifacts -> flat ``runs``, ``metrics``, ``query_results``, ``dag_results``."""
    raw = spark.read.option("multiLine", "true").schema(ARTIFACT_SCHEMA).json(path)
    runs = raw.select("benchmark_run_id", "error")
    metrics = raw.select("benchmark_run_id", F.explode("metrics").alias("m")).select(
        "benchmark_run_id", F.col("m")["metric_id"].alias("metric_id"), F.col("m")["metric_type"].alias("metric_type"),
        F.col("m").alias("fields"))
    qr = raw.select("benchmark_run_id", F.explode("query_results").alias("q")).select(
        "benchmark_run_id", "q.query_name", "q.partition.dataset", "q.partition.year", "q.partition.month",
        F.col("q.result.row_count").alias("row_count"), F.col("q.result.state").alias("state"),
        F.col("q.result.error").alias("error"), F.col("q.result.columns").alias("columns"),
        F.col("q.result.rows").alias("rows"))
    dags = raw.select("benchmark_run_id", F.explode("dag_results").alias("fields"))
    return {"runs": runs, "metrics": metrics, "query_results": qr, "dag_results": dags}


def run_template(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None,
                 args: Mapping[str, object] | None = None) -> DataFrame:
    """Run a parameterized SQL template.

    Table names bind through ``IDENTIFIER(:name)`` and values through named
    parameter markers, so nothing is spliced into the SQL text.  ``views``
    registers DataFrames as temp views first.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=dict(args or {}))
