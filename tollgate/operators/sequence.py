"""Ordered positions without a single-task global window.

``row_number()`` over a key puts every row of that key into one task; with
a hot key that is one task sorting a third of the data.  ``dense_index``
instead range-partitions on ``(keys..., order...)`` — the range bounds split
a hot key over many tasks — sorts within partitions, and turns the
per-partition row counter into a position with per-(key, partition) offsets
computed from a tiny count table.  The sorted, tagged rows are checkpointed
to the shared checkpoint folder so both uses read the same rows even if an
executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.session import checkpoint_root


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys of ``left`` are kept."""
    mine = {k: f"_join_{k}" for k in keys}
    right = right.withColumnsRenamed(mine)
    same = [F.col(k).eqNullSafe(F.col(m)) for k, m in mine.items()]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return left.join(right, condition, how).drop(*mine.values())


def dense_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                name: str = "_i", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row within its key by ``order``.

    ``order`` must make rows unique within a key for a deterministic result.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    sort_cols = [F.col(k) for k in keys] + order_cols
    tagged = (
        df.repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy(*keys, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_m0")
    )
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    return (
        join_null_safe(tagged, offsets.drop("_cnt"), [*keys, "_pid"])
        .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long"))
        .drop("_pid", "_mid", "_m0", "_off")
    )


def with_sequence(df: DataFrame, order: Sequence[str | Column], name: str = "sequence_position",
                  keys: Sequence[str] = ()) -> DataFrame:
    """Contiguous 1..N positions over an ordered grid (per ``keys``)."""
    return dense_index(df, keys, order, name="_seq0").withColumn(
        name, (F.col("_seq0") + 1).cast("int")).drop("_seq0")


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group by ``order`` (``min_by`` aggregate).

    A hash aggregate with map-side partials: a hot group costs one partial
    row per task.
    """
    cols = [c for c in df.columns if c not in group]
    key = F.struct(*[F.col(o) for o in order])
    # One min_by over the whole row keeps the columns of a single row.
    first = df.groupBy(*group).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), key).alias("_first"))
    return first.select(*group, *[F.col("_first")[c].alias(c) for c in cols]).select(*df.columns)


def first_per_dataset(parts: DataFrame, order: Sequence[str] = ("year", "month")) -> DataFrame:
    """First declared partition of each dataset."""
    return first_per_group(parts, ["dataset"], order)


def latest_at_or_before(events: DataFrame, points: DataFrame, keys: Sequence[str], event_time: str,
                        point_time: str, tiebreak: str, partitions: int | None = None) -> DataFrame:
    """As-of lookup: for every point, the latest event of the same key with
    ``event_time <= point_time`` (ties: largest ``tiebreak``).

    Returns the point columns plus ``_match``, a struct of the event's
    columns (NULL when no event precedes the point).  Events and points are
    sorted together by (key, time) with a range partitioner, so a hot key is
    spread over many tasks; each task carries the latest event forward
    within its slice, and the carry-in from earlier slices comes from a
    (key x partition) table — no pairs of events and points are formed.
    """
    spark = events.sparkSession
    checkpoint_root(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = list(keys)
    ev_struct = F.struct(*[F.col(c) for c in events.columns])
    pt_struct = F.struct(*[F.col(c) for c in points.columns])
    tb_type = events.schema[tiebreak].dataType
    ev = events.select(*[F.col(k) for k in keys], F.col(event_time).alias("_t"), F.lit(0).alias("_kind"),
                       F.col(tiebreak).alias("_tb"), ev_struct.alias("_e"),
                       F.lit(None).cast(points.select(pt_struct).schema[0].dataType).alias("_q"))
    pt = points.select(*[F.col(k) for k in keys], F.col(point_time).alias("_t"), F.lit(1).alias("_kind"),
                       F.lit(None).cast(tb_type).alias("_tb"),
                       F.lit(None).cast(events.select(ev_struct).schema[0].dataType).alias("_e"),
                       pt_struct.alias("_q"))
    sort_cols = [F.col(k) for k in keys] + [F.col("_t"), F.col("_kind"), F.col("_tb")]
    tagged = (
        ev.unionByName(pt)
        .repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    within = Window.partitionBy(*keys, "_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.withColumn("_local", F.last("_e", ignorenulls=True).over(within))
    tails = tagged.where(F.col("_kind") == 0).groupBy(*keys, "_pid").agg(F.max_by("_e", "_mid").alias("_tail"))
    slices = join_null_safe(tagged.select(*keys, "_pid").distinct(), tails, [*keys, "_pid"], "left")
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select(*keys, "_pid", F.last("_tail", ignorenulls=True).over(earlier).alias("_carry"))
    return (
        local.where(F.col("_kind") == 1)
        .transform(lambda d: join_null_safe(d, carry, [*keys, "_pid"], "left"))
        .select("_q.*", F.coalesce("_local", "_carry").alias("_match"))
    )


#: Bounds in microseconds that no time reaches.
_NEVER, _ALWAYS = -2 ** 62, 2 ** 62


def _latest_in_slice(keys: Sequence[str]):
    """Sweep of one sorted slice: each point gets the latest event before it in its key whose ``_end`` is at or after its ``_from``.

    Open events are held as a stack whose ends fall from bottom to top: an event that ends no later than one
    that starts after it can never be an answer again."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ends, ids = None, [], []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in (*keys, "_kind", "_end", "_from", "_tb")]
            for *key, kind, end, start, event in zip(*columns):
                if key != current:
                    current, ends, ids = key, [], []
                if kind == 0:
                    while ends and ends[-1] >= -end:
                        ends.pop()
                        ids.pop()
                    ends.append(-end)
                    ids.append(event)
                else:
                    at = bisect_right(ends, -start)
                    found.append(ids[at - 1] if at else None)
            points = batch.filter(pa.array([k == 1 for k in columns[len(keys)]], pa.bool_()))
            kept = [*keys, "_slice", "_from", "_q"]
            yield pa.RecordBatch.from_arrays([*[points.column(c) for c in kept], pa.array(found, batch.schema.field("_tb").type)],
                                             names=[*kept, "_hit"])

    return sweep


def latest_overlapping(events: DataFrame, points: DataFrame, keys: Sequence[str], event_start: str, event_end: str,
                       point_start: str, point_end: str, event_id: str, name: str = "_match",
                       partitions: int | None = None) -> DataFrame:
    """For every point interval, the ``event_id`` of the event of the same key with the latest start that overlaps it.

    Overlap: ``event_end >= point_start and event_start <= point_end``; a NULL
    bound is open (NULL starts count as earliest; ties of the start: larger id).
    Returns the point columns and ``name``, NULL without an overlapping event.
    Rows with a NULL key match nothing.

    No pairs are formed.  Events (by start) and points (by end) are sorted
    together with a range partitioner, so that a hot key is spread over many
    tasks.  One sweep answers each point from its own slice.  Points left over
    are sent to the one latest earlier slice of their key whose largest end
    reaches them (a table of key x slice) and, as the ends of a slice's events
    that can still be an answer fall with their start, an as-of lookup by end
    finds the event there, again without a task that meets a whole key.
    """
    spark = events.sparkSession
    checkpoint_root(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    q = F.struct(*[F.col(c) for c in points.columns])
    q_type = points.select(q).schema[0].dataType
    id_type = events.schema[event_id].dataType
    no = F.lit(None)
    ev = events.where(known).select(
        *keys, F.lit(False).alias("_open"), F.col(event_start).cast("timestamp").alias("_t"), F.lit(0).alias("_kind"),
        F.col(event_id).alias("_tb"), F.coalesce(F.unix_micros(F.col(event_end).cast("timestamp")), F.lit(_ALWAYS)).alias("_end"),
        no.cast("long").alias("_from"), no.cast(q_type).alias("_q"))
    pt = points.where(known).select(
        *keys, F.col(point_end).isNull().alias("_open"), F.col(point_end).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
        no.cast(id_type).alias("_tb"), no.cast("long").alias("_end"),
        F.coalesce(F.unix_micros(F.col(point_start).cast("timestamp")), F.lit(_NEVER)).alias("_from"), q.alias("_q"))
    order = [*keys, "_open", "_t", "_kind", "_tb"]
    tagged = (ev.unionByName(pt).repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
              .withColumn("_slice", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    schema = T.StructType([*[tagged.schema[k] for k in keys], tagged.schema["_slice"], tagged.schema["_from"], tagged.schema["_q"],
                           T.StructField("_hit", id_type)])
    swept = tagged.mapInArrow(_latest_in_slice(keys), schema).checkpoint(eager=True)
    # The one earlier slice that holds the answer of a point without one in its own.
    starts = tagged.where(F.col("_kind") == 0)
    reach = (starts.groupBy(*keys, "_slice").agg(F.max("_end").alias("reach"))
             .groupBy(*keys).agg(F.collect_list(F.struct(F.col("_slice").alias("pid"), "reach")).alias("_slices")))
    earlier = F.filter("_slices", lambda s: (s["pid"] < F.col("_slice")) & (s["reach"] >= F.col("_from")))
    routed = (swept.where(F.col("_hit").isNull()).join(reach, keys, "inner")
              .withColumn("_slice", F.array_max(F.transform(earlier, lambda s: s["pid"])))
              .where(F.col("_slice").isNotNull())
              .select(*keys, "_slice", (-F.col("_from")).alias("_at"), "_q"))
    later = Window.partitionBy(*keys, "_slice").orderBy("_mid").rowsBetween(1, Window.unboundedFollowing)
    skyline = (starts.withColumn("_after", F.max("_end").over(later))
               .where(F.col("_after").isNull() | (F.col("_end") > F.col("_after")))
               .select(*keys, "_slice", (-F.col("_end")).alias("_by"), F.col("_tb")))
    second = latest_at_or_before(skyline, routed, [*keys, "_slice"], "_by", "_at", "_tb", partitions)
    answered = (swept.where(F.col("_hit").isNotNull()).select("_q", F.col("_hit").alias("_found"))
                .unionByName(second.select("_q", F.col("_match._tb").alias("_found"))))
    unrouted = (swept.where(F.col("_hit").isNull()).join(reach, keys, "left")
                .where(F.coalesce(F.size(earlier), F.lit(0)) <= 0).select("_q", no.cast(id_type).alias("_found")))
    out = answered.unionByName(unrouted).select("_q.*", F.col("_found").alias(name))
    return out.unionByName(points.where(~known).withColumn(name, no.cast(id_type)))
