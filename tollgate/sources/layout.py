"""Physical file layout.

``rewrite_layout`` writes *exactly* ``n`` non-empty files per table
partition (fragmented) or one (compact) for all partitions in one job.
The source is staged once as plain files, in whatever order it comes.  A
scan of the partition columns counts the rows of every (partition, piece of a
staged file); where a piece begins and a running count inside it give every
row its position in its partition, equal runs of positions are the files, and
``repartitionById`` sends each (partition, file) to its own task.  That is the
one shuffle of whole rows: nothing is sorted or held for the positions.  Only
a layout in order is range-partitioned and sorted before it is staged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.operators.sequence import dense_index, join_null_safe
from tollgate.session import checkpoint_root, work_path

LAYOUTS = ("fragmented", "compact")


class LayoutError(ValueError):
    pass


def rewrite_layout(df: DataFrame, target: str, part_cols: Sequence[str], layout: str,
                   n_files: int = 16, source: str | None = None, strict: bool = True,
                   order: Sequence[str] = ()) -> None:
    """Rewrite ``df`` to ``target`` with a controlled file count.

    With ``order`` the files of a partition hold consecutive runs of its rows in
    that order (ties by all columns), sorted within each file, so ranges of the
    order columns meet in two files at most at the cut.  Files of a partition
    differ by one row at most.  ``df`` is read once, in order twice.

    Errors (fixed semantics): unknown layout; ``n_files < 2`` for the
    fragmented layout; source equals target; empty source; with
    ``strict``, a partition with fewer rows than ``n_files``.  Without
    ``strict`` such a partition gets one file per row (J10 then reports it).
    """
    if layout not in LAYOUTS:
        raise LayoutError(f"Unsupported layout: {layout}")
    if layout == "fragmented" and n_files < 2:
        raise LayoutError("A fragmented layout needs at least two files per partition")
    if source is not None and source.rstrip("/") == target.rstrip("/"):
        raise LayoutError("Source and target must differ")
    n = n_files if layout == "fragmented" else 1
    part_cols, order = list(part_cols), list(order)
    spark = df.sparkSession
    rows = df
    if n > 1 and order:
        values = [F.col(c) for c in df.columns if c not in part_cols and c not in order]
        by = [*part_cols, *order, *([F.xxhash64(*values), *values] if values else [])]
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        rows = df.repartitionByRange(n_parts, *by).sortWithinPartitions(*by)
    staged = work_path(spark, "layout-staged")
    try:
        rows.write.option("maxRecordsPerFile", 0).parquet(staged)
        _write_layout(spark.read.schema(df.schema).parquet(staged), target, part_cols, n, strict, order)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _running_count():
    """The task code, nested so that it is pickled by value: workers need not have this package."""
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """How many rows of the same slot came before, in one task's rows."""
        seen: dict[int, int] = {}
        for batch in batches:
            slots, at, sizes = np.unique(batch.to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
            by_slot = np.argsort(at, kind="stable")
            out = np.empty(len(at), np.int64)
            out[by_slot] = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            slots = slots.tolist()
            out += np.array([seen.get(s, 0) for s in slots], np.int64)[at]
            for s, size in zip(slots, sizes.tolist()):
                seen[s] = seen.get(s, 0) + size
            yield pa.array(out)

    return count


def _write_layout(staged: DataFrame, target: str, part_cols: list[str], n: int, strict: bool, order: list[str]) -> None:
    """Rows of staged files as ``n`` files per partition, in the order of the staged files' names and rows."""
    checkpoint_root(staged.sparkSession)
    # A piece is what one task reads of a staged file at once, so its rows come in one order in every scan.
    piece = {"_file": F.col("_metadata.file_name"), "_block": F.col("_metadata.file_block_start")}
    rows = staged.select("*", *[c.alias(k) for k, c in piece.items()])
    # One row per (table partition, piece): calendar-bounded, times the tasks that staged the source.
    pieces = rows.groupBy(*part_cols, *piece).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    sizes = pieces.groupBy(*part_cols).agg(F.sum("_n").alias("_rows")).checkpoint(eager=True)
    if sizes.isEmpty():
        raise LayoutError("Source is empty")
    if strict and n > 1 and not sizes.where(F.col("_rows") < n).isEmpty():
        raise LayoutError(f"A partition has fewer rows than {n} files")
    sizes = join_null_safe(sizes, dense_index(sizes.select(*part_cols), [], part_cols, name="_p"), part_cols)
    before = Window.partitionBy(*part_cols).orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = join_null_safe(pieces.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), sizes, part_cols)
    starts = starts.withColumn("_slot", F.monotonically_increasing_id()).checkpoint(eager=True)
    placed = join_null_safe(rows, F.broadcast(starts), [*part_cols, *piece])
    if n > 1:
        placed = placed.withColumn("_i", F.col("_start") + F.arrow_udf(_running_count(), "long")("_slot"))
    cut = F.expr(f"(_i * {n}) div _rows") if n > 1 else F.lit(0)
    out = placed.withColumn("_pid", (F.col("_p") * n + cut).cast("int")).repartitionById(int(sizes.count() * n), "_pid")
    if order:
        out = out.sortWithinPartitions(*part_cols, *order)
    (out.select(*staged.columns).write.mode("overwrite").option("maxRecordsPerFile", 0)
     .partitionBy(*part_cols).parquet(target))


def _partition_values(path_col, part_cols: Sequence[str]):
    return [F.regexp_extract(path_col, f"{c}=([^/]+)", 1).alias(c) for c in part_cols]


def file_inventory(spark: SparkSession, path: str, part_cols: Sequence[str]) -> DataFrame:
    """Per-partition file count, empty files, record count and bytes.

    Files are listed with the ``binaryFile`` source (content not read);
    record counts come from a metadata-column scan (``_metadata.file_path``)
    that reads no data columns.  Files without rows are the empty ones.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .option("recursiveFileLookup", "true").load(path)
               .select(F.col("path").alias("file_path"), F.col("length").alias("file_size")))
    rows = (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("records")))
    per_file = listing.join(rows, "file_path", "left").select(
        *_partition_values(F.col("file_path"), part_cols), "file_path", "file_size",
        F.coalesce("records", F.lit(0)).alias("records"))
    return per_file.groupBy(*part_cols).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.count_if(F.col("records") == 0).alias("empty_files"),
        F.sum("records").alias("record_count"),
        F.sum("file_size").alias("total_size"),
    )


def layout_totals(inventory: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of records, files and bytes."""
    return inventory.groupBy(*by).agg(
        F.sum("record_count").alias("record_count"), F.sum("file_count").alias("file_count"),
        F.sum("total_size").alias("total_size"))


def layout_gaps(inventory: DataFrame, table_rows: DataFrame, expected_files: int,
                part_cols: Sequence[str]) -> DataFrame:
    """Partitions whose layout differs from the expectation.

    Expected: ``expected_files`` files, no empty file, metadata record count
    equal to the table's row count (``table_rows``: part cols + row_count).
    """
    part_cols = list(part_cols)
    inv = inventory.select(*[F.col(c).cast("string").alias(c) for c in part_cols],
                           "file_count", "empty_files", "record_count")
    rows = table_rows.select(*[F.col(c).cast("string").alias(c) for c in part_cols], "row_count")
    j = inv.join(rows, part_cols, "full_outer")
    bad = ((F.coalesce("file_count", F.lit(0)) != expected_files) | (F.coalesce("empty_files", F.lit(0)) != 0)
           | (F.coalesce("record_count", F.lit(-1)) != F.coalesce("row_count", F.lit(-2))))
    return j.where(bad).withColumn("expected_files", F.lit(expected_files))
