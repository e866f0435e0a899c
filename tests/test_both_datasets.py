"""Queries that run on one dataset have a companion over both."""

import pytest

SF = "/root/testdata/sf0.001"
NAMES = ["layout_fragmented", "layout_compact", "layout_gaps", "layout_totals", "landed_scan", "preview_top_trips",
         "sql_template_broad_scan", "partition_calendar", "partition_gaps", "rerun_idempotence", "pruned_partition_scan"]


def test_companions_are_registered_with_sql():
    import __spark_entry__ as e
    queries, sql = e.queries(), e.oracle_sql()
    for name in NAMES:
        assert f"{name}_both" in queries
        assert "silver_yellow" in sql[f"{name}_both"] and "silver_green" in sql[f"{name}_both"]


@pytest.mark.parametrize("name", ["layout_totals", "pruned_partition_scan"])
def test_companion_covers_both_datasets(spark, name):
    import __spark_entry__ as e
    from tollgate.plans.datasets import silver

    got = e.queries()[f"{name}_both"](spark, SF)
    assert {r["dataset"] for r in got.select("dataset").distinct().collect()} == {"yellow", "green"}
    if name == "layout_totals":
        assert {r["dataset"]: r["record_count"] for r in got.collect()} == {
            d: silver(spark, SF, d).count() for d in ("yellow", "green")}


def test_checksum_manifest_reads_both_datasets(spark, monkeypatch):
    from tollgate.plans import registry_tables

    rewritten, seen = registry_tables._rewritten, []

    def record(spark, sf, kind, dataset="yellow"):
        seen.append(dataset)
        return rewritten(spark, sf, kind, dataset)

    monkeypatch.setattr(registry_tables, "_rewritten", record)
    got = registry_tables._each(registry_tables._checksums)(spark, SF)
    assert got.columns == ["dataset", "key", "mismatch"] and got.count() == 0 and set(seen) == {"yellow", "green"}
