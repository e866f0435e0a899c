"""Composite user-level jobs (C1-C4): the medallion pipeline.

Each job handles *all requested months at once* — one plan, one scan per
source, partition-scoped writes — instead of one application per month.
Tables are catalog names or paths under a shared warehouse folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tollgate.operators import marts, normalize, quality
from tollgate.schemas import (GOLD_PARTITION_COLUMNS, QUALITY_PARTITION_COLUMNS, SILVER,
                              SILVER_PARTITION_COLUMNS)
from tollgate.session import checkpoint_root
from tollgate.sources import files, tables


@dataclass(frozen=True)
class Warehouse:
    root: str

    def silver(self, dataset: str) -> str:
        return f"{self.root}/silver/{dataset}_trips"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality/silver_trip_quality_results"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/trip_revenue_monthly"


def build_silver(raw: DataFrame, dataset: str, target: str,
                 parts: Sequence[tuple[int, int]] | DataFrame | None = None) -> DataFrame:
    """Raw -> normalized silver -> dynamic partition overwrite.

    Returns the staged frame (for dry runs / audits).  ``parts`` restricts
    to the requested months (P11); None keeps every derived month.
    """
    staged = normalize.stage_trips(raw, dataset, parts)
    tables.overwrite_partitions(staged, target, SILVER_PARTITION_COLUMNS, order=["pickup_ts"],
                                following=normalize.following_columns(dataset))
    return staged


def audit_silver(spark: SparkSession, dataset: str, source: str, target: str | None,
                 parts: Sequence[tuple[int, int]] | None = None, context: dict | None = None,
                 rules: Sequence[quality.Rule] | None = None) -> tuple[DataFrame, bool]:
    """One-pass audit of the requested partitions, appended to history.

    A read failure, also one met only while the files are read, produces one
    ``silver_partition_read`` fail row per unreadable partition; the other
    requested partitions are audited one by one then.  Returns the audit
    rows and whether a hard check failed (the gate for C3).
    """
    checkpoint_root(spark)

    def audited(months: Sequence[tuple[int, int]] | None) -> DataFrame:
        # Inferred (actual) schema: V4 must see the table's real column types.
        silver = tables.read_partition(spark, source, months)
        wanted = None
        if months:
            wanted = spark.createDataFrame([(int(y), int(m)) for y, m in months], "year int, month int")
        # One aggregation pass over silver; the (partitions x checks) result is
        # checkpointed to shared storage so the append and the gate reuse it.
        return quality.audit(silver, dataset, parts=wanted, rules=rules, context=context).checkpoint(eager=True)

    try:
        rows = audited(parts)
    except Exception as error:  # noqa: BLE001 - read failures become audit rows, all else is raised
        if not parts or not files.is_read_error(error):
            raise
        each = []
        for month in parts:
            try:
                each.append(audited([month]))
            except Exception as error:  # noqa: BLE001
                if not files.is_read_error(error):
                    raise
                each.append(quality.failed_read_rows(spark, dataset, [month], error, context))
        rows = reduce(DataFrame.unionByName, each).checkpoint(eager=True)
    if target is not None:
        tables.append_rows(rows, target, QUALITY_PARTITION_COLUMNS)
    return rows, quality.has_hard_failures(rows)


def build_gold(spark: SparkSession, sources: dict[str, str], target: str | None,
               parts: Sequence[tuple[int, int]] | None = None, failed: DataFrame | None = None) -> DataFrame:
    """Non-empty guard, grouped revenue aggregate, partition overwrite.

    ``failed`` (dataset, year, month) lists partitions that the gate holds
    back: they get no gold rows, and gold they had stays."""
    frames = []
    for dataset, source in sources.items():
        silver = tables.read_partition(spark, source, parts, schema=SILVER.get(dataset))
        frames.append(marts.with_dataset(silver.select(
            "year", "month", "is_valid_trip", "fare_amount", "tip_amount", "tolls_amount",
            "total_amount", "trip_distance", "trip_duration_min"), dataset))
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    gold = marts.monthly_revenue(union)
    if failed is not None:
        gold = quality.without_partitions(gold, failed)
    # One row per (dataset, month): materialize once so the guard and the
    # write share a single scan of silver (reliable checkpoint, shared folder).
    checkpoint_root(spark)
    gold = gold.checkpoint(eager=True)
    if parts:
        wanted = spark.createDataFrame(
            [(ds, int(y), int(m)) for ds in sources for y, m in parts], "dataset string, year int, month int")
        if failed is not None:
            wanted = quality.without_partitions(wanted, failed)
        missing = wanted.join(gold.select(*GOLD_PARTITION_COLUMNS), GOLD_PARTITION_COLUMNS, "left_anti")
        # At most as many rows as the caller asked for.
        absent = [tuple(r) for r in missing.collect()]
        if absent:
            raise RuntimeError(f"No silver rows found for {len(absent)} partitions: {absent}")
    if target is not None:
        tables.overwrite_partitions(gold, target, GOLD_PARTITION_COLUMNS)
    return gold


def medallion_run(spark: SparkSession, raw: dict[str, DataFrame], warehouse: Warehouse,
                  parts: Sequence[tuple[int, int]] | None = None, context: dict | None = None,
                  rules: dict[str, Sequence[quality.Rule]] | None = None,
                  gate: bool = True) -> dict[str, object]:
    """C4: C1 -> C2 (hard gate) -> C3 for every dataset and month at once.

    The gate holds back the dataset-months with a hard failure; all others
    get gold."""
    for dataset, frame in raw.items():
        build_silver(frame, dataset, warehouse.silver(dataset), parts)
    failures, held = {}, None
    for dataset in raw:
        rows, failures[dataset] = audit_silver(spark, dataset, warehouse.silver(dataset), warehouse.quality,
                                 parts, context, (rules or {}).get(dataset))
        bad = quality.hard_failed_partitions(rows)
        held = bad if held is None else held.unionByName(bad)
    failed = held if gate and any(failures.values()) else None
    sources = {ds: warehouse.silver(ds) for ds in raw}
    if failed is not None and parts:
        # Scan only what passed (and so never what can't be read); at most the requested partitions.
        bad = {tuple(r) for r in failed.collect()}
        good = {ds: [(y, m) for y, m in parts if (ds, int(y), int(m)) not in bad] for ds in raw}
        built = [build_gold(spark, {ds: sources[ds]}, warehouse.gold, months) for ds, months in good.items() if months]
        return {"gold_built": bool(built), "hard_failures": failures, "failed_partitions": failed}
    gold = build_gold(spark, sources, warehouse.gold, parts, failed)
    return {"gold_built": not gold.isEmpty(), "hard_failures": failures, "failed_partitions": held}
