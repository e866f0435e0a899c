"""Incremental month ingest (I1-I4) on Structured Streaming.

The month cursor is the streaming checkpoint: a file source over the landing
zone (explicit schema, bounded files per trigger) with
``trigger(availableNow=True)`` reads every file that arrived since the last run
and stops.  ``foreachBatch`` only notes which months arrived, in a ledger keyed
by micro-batch; afterwards each of these months goes once through stage ->
quality -> gold, and is settled in the ledger when its tables are written.
Months that fail stay on a retry list.  A restarted query resumes from the
checkpoint; a replayed batch, and a rebuild that is done again after a crash,
change no table (I4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tollgate.functions.scalar import next_partition  # noqa: F401  (I1, re-exported)
from tollgate.operators import marts, normalize, quality
from tollgate.schemas import GOLD_PARTITION_COLUMNS, QUALITY_PARTITION_COLUMNS, SILVER, SILVER_PARTITION_COLUMNS
from tollgate.session import checkpoint_root
from tollgate.sources import files, tables


def calendar(start_year: int | F.Column, start_month, end_year, end_month) -> DataFrame:
    """Every (year, month) from start to end inclusive (one row each)."""
    from pyspark.sql import SparkSession as _S

    spark = _S.getActiveSession()
    lit = lambda v: v if isinstance(v, F.Column) else F.lit(int(v))
    start = F.make_date(lit(start_year), lit(start_month), F.lit(1))
    end = F.make_date(lit(end_year), lit(end_month), F.lit(1))
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr("interval 1 month"))).alias("d")).select(
        F.year("d").alias("year"), F.month("d").alias("month"))


def month_span(available: DataFrame) -> DataFrame:
    """Calendar spanning the available months (first to last)."""
    bounds = available.select((F.col("year") * 12 + F.col("month") - 1).alias("m")).agg(
        F.min("m").alias("lo"), F.max("m").alias("hi"))
    to_date = lambda c: F.make_date((F.col(c) / 12).cast("int"), (F.col(c) % 12 + 1).cast("int"), F.lit(1))
    return bounds.select(F.explode(F.sequence(to_date("lo"), to_date("hi"), F.expr("interval 1 month"))).alias("d")) \
        .select(F.year("d").alias("year"), F.month("d").alias("month"))


def partition_gaps(calendar_df: DataFrame, available: DataFrame) -> DataFrame:
    """Calendar months without a raw file (skipped; the cursor advances)."""
    have = available.select(F.col("year").cast("int"), F.col("month").cast("int")).distinct()
    return calendar_df.join(have, ["year", "month"], "left_anti")


def next_unloaded(calendar_df: DataFrame, loaded: DataFrame) -> DataFrame:
    """The first calendar month not loaded yet (empty when done)."""
    todo = calendar_df.join(loaded.select("year", "month").distinct(), ["year", "month"], "left_anti")
    return todo.agg(F.min_by(F.struct("year", "month"), F.col("year") * 12 + F.col("month")).alias("p")) \
        .where(F.col("p").isNotNull()).select("p.year", "p.month")


ARRIVALS = "dataset string, batch_id long, year int, month int"
SETTLED = "dataset string, year int, month int, batch_id long, attempt int, status string, error string, settled_at timestamp"


class Ledger:
    """What arrived and what was settled, as two small tables (at most a row per month and micro-batch).

    ``arrivals`` is keyed by micro-batch: a replayed batch writes the same
    partition again.  ``settled`` has one row per rebuild of a month, added only
    after its sinks are written.  Batch numbers belong to one streaming
    checkpoint, so a new checkpoint needs a new ledger.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.arrivals, self.settled = spark, f"{root.rstrip('/')}/arrivals", f"{root.rstrip('/')}/settled"

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path) if files.stored(self.spark, path) else self.spark.createDataFrame([], schema)

    def arrived(self, batch: DataFrame, batch_id: int, dataset: str) -> None:
        """Note the months of a micro-batch (path); the whole work of ``foreachBatch``."""
        place = F.regexp_extract("path", r"/year=(\d+)/month=(\d+)/", 1), F.regexp_extract("path", r"/year=(\d+)/month=(\d+)/", 2)
        dated = batch.select(*[F.try_to_number(p, F.lit("9999")).cast("int").alias(n) for p, n in zip(place, ("year", "month"))]).na.drop()
        months = dated.groupBy("year", "month").agg(F.lit(dataset).alias("dataset"), F.lit(batch_id).cast("long").alias("batch_id"))
        tables.overwrite_partitions(months.select("year", "month", "dataset", "batch_id"), self.arrivals, ["dataset", "batch_id"])

    def last(self, dataset: str) -> DataFrame:
        """The last settled row of each month."""
        return (self._read(self.settled, SETTLED).where(F.col("dataset") == dataset).groupBy("year", "month")
                .agg(F.max(F.struct("batch_id", "attempt", "status", "error")).alias("s")).select("year", "month", "s.*"))

    def pending(self, dataset: str) -> list[tuple[int, int, int, int]]:
        """(year, month, batch, attempt) of months that got files since they were settled, or whose last rebuild failed."""
        newest = self._read(self.arrivals, ARRIVALS).where(F.col("dataset") == dataset).groupBy("year", "month").agg(F.max("batch_id").alias("newest"))
        rows = newest.join(self.last(dataset), ["year", "month"], "left").where(
            F.col("batch_id").isNull() | (F.col("newest") > F.col("batch_id")) | (F.col("status") == "failed"))
        return sorted((r.year, r.month, r.newest, r.attempt + 1 if r.batch_id == r.newest else 0) for r in rows.collect())

    def retry_list(self, dataset: str) -> DataFrame:
        """Months whose last rebuild failed, with the error; they are tried again at the next run."""
        return self.last(dataset).where("status = 'failed'").select("year", "month", "attempt", "error")

    def settle(self, dataset: str, outcome: dict[tuple[int, int, int, int], str | None]) -> None:
        """Add the outcome (an error, or None) of rebuilt months."""
        rows = [(dataset, y, m, b, a, "failed" if e else "done", e) for (y, m, b, a), e in outcome.items()]
        if rows:
            out = self.spark.createDataFrame(rows, "dataset string, year int, month int, batch_id long, attempt int, status string, error string")
            out.coalesce(1).withColumn("settled_at", F.current_timestamp()).write.mode("append").parquet(self.settled)


def _run_ids(rows: DataFrame, dataset: str, months: Sequence[tuple[int, int, int, int]]) -> DataFrame:
    """Audit rows with the rebuild that made them in ``dag_run_id``: the same for a rebuild that is done again after a crash."""
    name = F.create_map(*[F.lit(x) for y, m, b, a in months for x in (y * 100 + m, f"{dataset}-{y}-{m:02d}-b{b}-a{a}")])
    own = F.try_element_at(name, F.col("year") * 100 + F.col("month"))
    return rows.withColumn("dag_run_id", F.concat_ws(":", "dag_run_id", own))


def record_audit(rows: DataFrame, target: str, months: Sequence[tuple[int, int]]) -> None:
    """Add audit rows to the history of their months, in place of rows of the same ``dag_run_id``.

    Only the months' own partitions are rewritten, so doing it again changes nothing."""
    spark = rows.sparkSession
    if files.stored(spark, target):
        have = tables.read_partition(spark, target, months, schema=rows.schema).where(
            F.col("dataset").isin([r[0] for r in rows.select("dataset").distinct().collect()]))
        old = have.join(rows.select("dag_run_id").distinct(), "dag_run_id", "left_anti").select(*rows.columns)
        rows = old.unionByName(rows).checkpoint(eager=True)
    tables.overwrite_partitions(rows, target, QUALITY_PARTITION_COLUMNS)


def rebuild_months(spark: SparkSession, months: Sequence[tuple[int, int, int, int]], dataset: str, source: str, schema: T.StructType,
                   silver_path: str, quality_path: str | None, gold_path: str, context: dict | None = None,
                   rules: Sequence[quality.Rule] | None = None, gate: bool = True) -> dict[tuple[int, int, int, int], str | None]:
    """stage -> quality -> gold of all ``months`` (year, month, batch, attempt) at once, from their complete landing partitions.

    Silver and Gold are partition overwrites and audit rows replace those of the
    same rebuild, so a repeated rebuild converges.  Months with a hard failure
    get no Gold.  If files can't be read, the months are halved until the
    unreadable ones are alone; those get a failed read row.  Returns the error of
    each month, None where it succeeded.
    """
    plain = [(y, m) for y, m, _, _ in months]
    checkpoint_root(spark)
    try:
        landed = spark.read.schema(schema).option("basePath", source).parquet(source).where(normalize.partition_predicate(plain))
        # Keep rows whose pickup month is the month of their file.
        raw = normalize.rename_columns(landed, normalize.RENAMES[dataset])
        pickup = F.to_timestamp("pickup_ts")
        raw = raw.where((F.year(pickup) == F.col("year")) & (F.month(pickup) == F.col("month")))
        silver = normalize.normalize(raw.drop("year", "month"), dataset)
        tables.overwrite_partitions(silver, silver_path, SILVER_PARTITION_COLUMNS, order=["pickup_ts"],
                                    following=normalize.following_columns(dataset))
        part = tables.read_partition(spark, silver_path, plain, schema=SILVER.get(dataset))
        gold, failed = marts.monthly_revenue(part, dataset), set()
        if quality_path is not None:
            wanted = spark.createDataFrame(plain, "year int, month int")
            rows = _run_ids(quality.audit(tables.read_partition(spark, silver_path, plain), dataset, parts=wanted, rules=rules, context=context),
                            dataset, months).checkpoint(eager=True)
            record_audit(rows, quality_path, plain)
            if gate:
                held = quality.hard_failed_partitions(rows)
                failed = {(r.year, r.month) for r in held.collect()}
                gold = quality.without_partitions(gold, held)
        tables.overwrite_partitions(gold, gold_path, GOLD_PARTITION_COLUMNS)
        return {k: "hard quality failure" if k[:2] in failed else None for k in months}
    except Exception as error:  # noqa: BLE001 - read errors alone are a month's fault
        if not files.is_read_error(error):
            raise
        if len(months) > 1:
            half, args = len(months) // 2, (dataset, source, schema, silver_path, quality_path, gold_path, context, rules, gate)
            return {**rebuild_months(spark, months[:half], *args), **rebuild_months(spark, months[half:], *args)}
        if quality_path is not None:
            rows = _run_ids(quality.failed_read_rows(spark, dataset, plain, error, context), dataset, months).checkpoint(eager=True)
            record_audit(rows, quality_path, plain)
        return {months[0]: f"read error: {str(error).splitlines()[0][:300]}"}


def settle_months(spark: SparkSession, ledger: Ledger, dataset: str, *args, **named) -> dict[tuple[int, int, int, int], str | None]:
    """Rebuild each pending month once (arguments of :func:`rebuild_months`) and note the outcome: a month advances only on success."""
    months = ledger.pending(dataset)
    outcome = rebuild_months(spark, months, dataset, *args, **named) if months else {}
    ledger.settle(dataset, outcome)
    return outcome


def ingest_available(spark: SparkSession, source: str, schema: T.StructType, dataset: str,
                     silver_path: str, gold_path: str, checkpoint: str,
                     quality_path: str | None = None, files_per_trigger: int = 8,
                     context: dict | None = None, rules: Sequence[quality.Rule] | None = None,
                     gate: bool = True, ledger: str | None = None) -> StreamingQuery:
    """Ingest every month that arrived in ``source`` since the last run, and try failed months again.

    ``source`` is a landing zone partitioned ``year=/month=``; ``schema``
    is the raw file schema (partition columns are added).  Micro-batches only
    note their months in the ledger (``ledger``, by default beside the
    checkpoint); when the backlog is through, each pending month is rebuilt once,
    however many batches its files came in.  Returns the finished query.
    """
    full = T.StructType(list(schema.fields) + [T.StructField("year", T.IntegerType()),
                                               T.StructField("month", T.IntegerType())])
    book = Ledger(spark, ledger or f"{checkpoint.rstrip('/')}-ledger")
    # Paths are all that the cursor needs: files are opened by the rebuild, where one that can't be read holds up its own month only.
    stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(source).select("path"))
    q = (stream.writeStream
         .foreachBatch(lambda df, batch_id: book.arrived(df, batch_id, dataset))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    settle_months(spark, book, dataset, source, full, silver_path, quality_path, gold_path, context, rules, gate)
    return q


def partition_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Record count per partition (the snapshot a re-run is compared with)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))


def rerun_consistency(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """I4: per-partition record counts of two runs and whether they agree.

    Inputs are :func:`partition_counts` snapshots taken after each run.
    """
    a = first.select(*keys, F.col("records").alias("records_first"))
    b = second.select(*keys, F.col("records").alias("records_second"))
    return a.join(b, list(keys), "full_outer").withColumn(
        "consistent", F.coalesce(F.col("records_first") == F.col("records_second"), F.lit(False)))
