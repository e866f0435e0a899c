"""Proportional stratified interleaving: shards of equal row counts that all hold the mixture.

Rows are shuffled by a seeded hash and ranked within their stratum (source).
The rank as a fraction of the stratum, (rank + 1/2) / rows, sorts all strata
into one order in which every stretch holds them in proportion; the order is cut
into shards whose row counts differ by at most one.  Both ranks are dense
positions over range partitions, so a stratum with a third of all rows is spread
over many tasks and no window runs over a whole stratum.

Defined results: null strata form one stratum of their own; null and empty texts
are rows as any other; repeated rows are placed one by one (rows equal in every
column are interchangeable, all others are told apart by a 128-bit hash of all
columns).  An empty table gives no rows; with fewer rows than shards some shards
are empty.  Other columns are kept; the added names get a leading ``_`` if they
are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import fresh
from tollgate.operators.sequence import dense_index, join_null_safe

SHARDS, SEED = 40, 20_240
#: Bytes that a row counts besides its text.
OVERHEAD = 16


def row_hash(df: DataFrame, seed: int) -> Column:
    """A seeded hash of all columns (maps through their JSON, which Spark's hashes leave out)."""
    return F.xxhash64(F.lit(seed), *[F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else F.struct(F.col(c))
                                     for f in df.schema.fields for c in [f"`{f.name}`"]])


def interleave(df: DataFrame, stratum: str | Column = "source", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard)."""
    shard, slot = fresh(df, "shard"), fresh(df, "slot")
    rows = df.select((F.col(stratum) if isinstance(stratum, str) else stratum).alias("stratum"), row_hash(df, seed).alias("h"),
                     row_hash(df, seed + 1).alias("g"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    ranked = dense_index(rows, ["stratum"], ["h", "g"], name="rank")
    counts = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = join_null_safe(ranked, counts, ["stratum"]).withColumn("part", (2 * F.col("rank") + 1) / (2 * F.col("n")))
    placed = dense_index(parts, [], ["part", "stratum", "h", "g"], name="at")
    at, of = F.col("at"), F.lit(total)
    number = F.floor(F.expr(f"at * {shards} div {max(total, 1)}")).cast("int")
    first = F.expr(f"(number * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("number", number).select("row.*", F.col("number").alias(shard), (at - first).cast("long").alias(slot))


def write_shards(df: DataFrame, path: str, stratum: str | Column = "source", shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes whole rows as Parquet, one folder per shard, ordered by slot in each file."""
    out = interleave(df, stratum, shards, seed)
    shard, slot = out.columns[-2:]
    (out.repartitionByRange(shards, shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path))


def shard_plan(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Digest of the placement; the texts themselves don't move."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", F.col("source").alias("stratum"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    return interleave(narrow, "stratum", shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("stratum").alias("source"))
