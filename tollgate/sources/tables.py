"""Table management (S3, S5-S10, S19) on plain parquet tables.

A *table* is either a catalog name (``db.tbl``) or a path on shared
storage.  Writes that replace data are partition-scoped and retry-safe:
dynamic partition overwrite replaces exactly the partitions present in the
frame, so re-running a job for the same months converges to the same table.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import checkpoint_root


def _is_path(table: str) -> bool:
    return "/" in table or ":" in table


def read_table(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    if _is_path(table):
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(table)
    return spark.table(table)


def read_partition(spark: SparkSession, table: str, parts: Sequence[tuple] | None = None,
                   part_cols: Sequence[str] = ("year", "month"),
                   schema: T.StructType | None = None) -> DataFrame:
    """S3: table scan restricted to partitions via literal predicates.

    Literal equality on partition columns becomes ``PartitionFilters`` in the
    file scan, so only the listed directories are read.  A known ``schema``
    (including the partition columns) skips footer schema inference.
    """
    df = read_table(spark, table, schema)
    if not parts:
        return df
    pred = None
    for values in parts:
        term = None
        for c, v in zip(part_cols, values):
            t = F.col(c) == F.lit(v)
            term = t if term is None else (term & t)
        pred = term if pred is None else (pred | term)
    return df.where(pred)


def list_namespaces(spark: SparkSession) -> DataFrame:
    """Catalog namespaces."""
    return spark.sql("SHOW NAMESPACES")


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 part_cols: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``.

    Creates the namespace first.  For path tables this is a no-op: the
    first write defines the layout.
    """
    if _is_path(name):
        return
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parted = f" PARTITIONED BY ({', '.join(part_cols)})" if part_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parted}")


def clustered_for_write(df: DataFrame, part_cols: Sequence[str], order: Sequence[str] = (),
                        partitions: int | None = None, following: Mapping[str, Column] | None = None) -> DataFrame:
    """Cluster rows by table partition before a partitioned write.

    Uses the ``rebalance`` hint on the partition columns: a hash shuffle that
    AQE then re-plans at runtime — skewed table partitions are split into
    advisory-sized tasks, small ones are coalesced — so each task writes
    few partition directories (no small-file explosion), a hot month does
    not become one giant task, and no sampling pass over the input is needed
    (unlike range partitioning).  ``order`` sorts rows within each task for
    better compression / min-max pruning inside the files.  ``following``
    gives columns of ``df`` as expressions of its other columns: they are left
    out of the shuffle and computed after it.
    """
    if not part_cols:
        return df
    following = following or {}
    out = df.drop(*following).hint("rebalance", *part_cols)
    if order:
        out = out.sortWithinPartitions(*part_cols, *order)
    if following:
        out = out.select(*[following[c].alias(c) if c in following else c for c in df.columns])
    return out


def overwrite_partitions(df: DataFrame, table: str, part_cols: Sequence[str],
                         order: Sequence[str] = (), clear_empty: Sequence[tuple] = (),
                         following: Mapping[str, Column] | None = None) -> None:
    """Replace only the partitions present in ``df`` (retry-safe).

    A zero-row frame replaces nothing.  ``clear_empty`` explicitly deletes
    listed partitions (values in ``part_cols`` order) — the opt-in for a
    partition that should become empty.  ``following``: see :func:`clustered_for_write`.
    """
    spark = df.sparkSession
    out = clustered_for_write(df, part_cols, order, following=following)
    if _is_path(table):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*part_cols).parquet(table))
    else:
        prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            cols = spark.table(table).columns
            out.select(*cols).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    for values in clear_empty:
        delete_partition(spark, table, part_cols, values)


# The folder of NULL and empty partition values, and the characters that are written as %XX in folder names.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = frozenset([chr(c) for c in range(1, 32)] + list("\"#%'*/:=?\\\x7f{[]^"))


def partition_folder(column: str, value) -> str:
    """``column=value`` as Spark names the partition's folder."""
    def escape(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)

    text = {True: "true", False: "false"}[value] if isinstance(value, bool) else "" if value is None else str(value)
    return f"{escape(column)}={escape(text) if text else NULL_PARTITION}"


def _partition_spec(column: str, value) -> str:
    """``column = literal`` of a catalog partition specification."""
    if value is None:
        return f"`{column}` = NULL"
    if isinstance(value, (bool, int)):
        return f"`{column}` = {str(value).lower()}"
    return f"`{column}` = '" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def delete_partition(spark: SparkSession, table: str, part_cols: Sequence[str], values: Sequence) -> None:
    """Drop one partition, which may be the NULL one or have a name that its folder escapes."""
    if not _is_path(table):
        spec = ", ".join(_partition_spec(c, v) for c, v in zip(part_cols, values))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        return
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sub = "/".join(partition_folder(c, v) for c, v in zip(part_cols, values))
    path = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{sub}")
    path.getFileSystem(conf).delete(path, True)


def append_rows(df: DataFrame, table: str, part_cols: Sequence[str] = ()) -> None:
    """Append-only history (never overwritten)."""
    if _is_path(table):
        w = df.write.mode("append")
        if part_cols:
            w = w.partitionBy(*part_cols)
        w.parquet(table)
    else:
        df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=False)


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: cast present columns, typed NULL for absent ones."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def evolve_schema(spark: SparkSession, table: str, wanted: T.StructType) -> list[str]:
    """Add only the missing columns, then verify none is missing.

    Catalog tables get ``ALTER TABLE ADD COLUMNS``; path tables are read with
    ``mergeSchema`` and the missing columns become typed NULLs on read (no
    rewrite).  Returns the added column names.
    """
    current = read_table(spark, table).schema
    have = {f.name for f in current.fields}
    missing = [f for f in wanted.fields if f.name not in have]
    if missing and not _is_path(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
        after = {f.name for f in spark.table(table).schema.fields}
        still = [f.name for f in wanted.fields if f.name not in after]
        if still:
            raise RuntimeError(f"Schema evolution left columns missing: {still}")
    return [f.name for f in missing]


def read_evolved(spark: SparkSession, table: str, wanted: T.StructType) -> DataFrame:
    """Read a path table under the evolved schema (old files -> NULL columns)."""
    return conform_to_schema(spark.read.option("mergeSchema", "true").parquet(table), wanted)


def replace_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Idempotent reload — rows of the new keys replace the old ones.

    ``existing`` minus the keys present in ``new`` (left anti join on the
    key), plus ``new``.  Reloading the same artifact N times leaves one row
    per key.  Returns the replacement content; write it with
    :func:`overwrite_partitions` (only affected partitions change).
    """
    keys = new.select(key).distinct()
    kept = existing.join(keys, key, "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def reload_by_key(spark: SparkSession, table: str, new: DataFrame, key: str, part_cols: Sequence[str],
                  scope: Column | None = None) -> None:
    """S10 on a stored table: afterwards each key of ``new`` has the rows of ``new`` only.

    Old rows of these keys go from whichever partition they are in, and
    ``scope`` (a condition on stored rows, such as one run's id) names rows
    that go even where ``new`` no longer has their key.  Only partitions that
    lose or get rows are rewritten; those left without rows are deleted.
    Repeating the reload changes nothing.
    """
    checkpoint_root(spark)
    existing = read_table(spark, table)
    new = new.select(*existing.columns).checkpoint(eager=True)
    keys = new.select(F.col(key).alias("_key")).distinct()
    stale = existing.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    if scope is not None:
        stale = stale.unionByName(existing.where(scope))

    def places(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"_p_{c}") for c in part_cols]).distinct()

    same = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in part_cols]
    touched = places(stale).union(places(new)).distinct().checkpoint(eager=True)
    kept = existing.join(touched, same, "left_semi").join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    if scope is not None:
        kept = kept.where(~F.coalesce(scope, F.lit(False)))
    content = kept.unionByName(new).checkpoint(eager=True)
    emptied = touched.join(content.select(*part_cols).distinct(), same, "left_anti").collect()  # partition values only
    overwrite_partitions(content, table, part_cols, clear_empty=[tuple(r) for r in emptied])


def dry_run(df: DataFrame) -> T.StructType:
    """Validate the plan (analysis only, no job) and return the output schema.

    The caller skips the sink; resolving the schema fails on any analysis
    error exactly as the real write would.
    """
    return df.schema


class Rehearsal(NamedTuple):
    """What a write would have done: output schema, formatted plan, and the observed counters."""

    schema: T.StructType
    plan: str
    counters: dict[str, Any]


def rehearse(df: DataFrame, counters: Mapping[str, Column]) -> Rehearsal:
    """Run the whole plan into the ``noop`` sink, which writes nothing.

    ``counters`` are aggregates that are observed on the way, so audit figures
    of a dry run cost no scan of their own.  Errors of reading or computing
    surface as in the real write.  An empty frame gives the aggregates of no rows.
    """
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counters.items()])
    out.write.format("noop").mode("overwrite").save()
    return Rehearsal(df.schema, text.getvalue(), dict(seen.get))
