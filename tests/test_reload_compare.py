"""Reloads that empty NULL and escaped partitions; comparison of nested, NULL-keyed and keyless results."""

import pytest
from pyspark.sql import functions as F

from tollgate.operators import coverage
from tollgate.sources import tables

HARD = [None, "a:b", "it's", 'q"u\\o', "100%", "x=y/z", "{[^]}#?*", "a b"]


@pytest.mark.parametrize("old", HARD)
def test_reload_empties_hard_partitions(spark, tmp_table, old):
    schema = "id string, v int, c string"
    tables.overwrite_partitions(spark.createDataFrame([("m1", 1, old), ("m2", 2, "keep")], schema), tmp_table, ["c"])
    for _ in range(2):
        tables.reload_by_key(spark, tmp_table, spark.createDataFrame([("m1", 7, "y")], schema), "id", ["c"])
        assert sorted((r.id, r.v, r.c) for r in spark.read.parquet(tmp_table).collect()) == [("m1", 7, "y"), ("m2", 2, "keep")]


def test_catalog_partitions_dropped(spark):
    spark.sql("DROP TABLE IF EXISTS hard_parts")
    spark.sql("CREATE TABLE hard_parts (v int, c string, n int) USING parquet PARTITIONED BY (c, n)")
    spark.createDataFrame([(1, None, 1), (2, "it's", 2), (3, "a:b", None), (4, "z\\k", 4), (5, "keep", 5)], "v int, c string, n int").write.insertInto("hard_parts")
    for part in ((None, 1), ("it's", 2), ("a:b", None), ("z\\k", 4)):
        tables.delete_partition(spark, "hard_parts", ["c", "n"], part)
    assert [r.v for r in spark.table("hard_parts").collect()] == [5]
    spark.sql("DROP TABLE hard_parts")


def test_keys_with_null(spark):
    a = spark.createDataFrame([(1, "x"), (None, "x"), (2, None), (2, None)], "k int, t string")
    b = spark.createDataFrame([(None, "x"), (2, None), (None, None)], "k int, t string")
    assert {(r.k, r.t, r.gap) for r in coverage.coverage_gaps(a, b, ["k", "t"]).collect()} == {(1, "x", "missing"), (None, None, "unexpected")}
    assert {(r.k, r.side) for r in coverage.reconcile_ids(a, b, "k").collect()} == {(1, "only_artifact")}
    assert coverage.coverage_gaps(a, a, ["k", "t"]).isEmpty() and coverage.coverage_gaps(a.limit(0), a.limit(0), ["k"]).isEmpty()
    same = coverage.results_equivalent(b, b, ["k", "t"])
    assert same.isEmpty() and "FullOuter" in same._jdf.queryExecution().toString() and same._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    got = coverage.results_equivalent(a.dropDuplicates().withColumn("v", F.lit(1)), b.withColumn("v", F.lit(2.0)), ["k", "t"])
    assert {(r.k, r.t, r.mismatch, r.column) for r in got.collect()} == {(1, "x", "missing_right", None), (None, None, "missing_left", None),
                                                                    (None, "x", "value", "v"), (2, None, "value", "v")}


NESTED = "k int, s struct<a:double,b:array<double>>, m map<string,array<double>>, d double, f float"


def nested(e=0.0, **change):
    row = {"s": (1.0 + e, [1e12 * (1 + e), None, 3.0]), "m": {"x": [0.5 + e], "y": None}, "d": float("nan"), "f": float("inf")}
    return (1, *({**row, **change}.values()))


@pytest.mark.parametrize("change, column", [({}, None), ({"s": (1.0, [1e12, 2.0, 3.0])}, "s"), ({"s": (1.0, [1e12, None])}, "s"), ({"s": (None, [1e12, None, 3.0])}, "s"),
                                            ({"m": {"x": [0.5], "z": None}}, "m"), ({"m": {"x": [0.6], "y": None}}, "m"), ({"m": None}, "m"), ({"d": 1.0}, "d"),
                                            ({"f": float("-inf")}, "f"), ({"f": 1.0}, "f"), ({"d": None}, "d")])
def test_nested_values(spark, change, column):
    a, b = spark.createDataFrame([nested()], NESTED), spark.createDataFrame([nested(1e-12, **change)], NESTED)
    assert [r.column for r in coverage.results_equivalent(a, b, ["k"]).collect()] == ([column] if column else [])
    assert coverage.rows_equivalent(a, b) == (column is None)


def test_rows_without_keys(spark):
    a = spark.createDataFrame([("x", 1.0000005), ("x", 2.0), (None, None), ("y", 5.0), ("y", 5.0)], "t string, v double")
    b = spark.createDataFrame([("y", 5.0), ("x", 2.0000000001), ("x", 1.0000004999), ("y", 5.0000000004), (None, None)], "t string, v double")
    assert coverage.rows_equivalent(a, b)
    assert not coverage.rows_equivalent(a, b.where("v < 5 OR v IS NULL"))
    assert not coverage.rows_equivalent(a, b.dropDuplicates(["t"]))
    got = coverage.row_mismatches(a, b.withColumn("v", F.when(F.col("t") == "x", F.col("v") + 1).otherwise(F.col("v"))))
    assert {(r.mismatch, r.column) for r in got.collect()} == {("value", "v")} and got.count() == 2
    only = spark.createDataFrame([(1.0,), (float(2),)], "v double")
    assert coverage.rows_equivalent(only, only.orderBy(F.desc("v"))) and coverage.rows_equivalent(only.limit(0), only.limit(0))


def test_empty_selection_is_an_error(spark):
    parts = spark.createDataFrame([("green", 2014, 1)], "dataset string, year int, month int")
    assert coverage.select_partitions(parts, "green", require=True).count() == 1
    with pytest.raises(ValueError, match="No partitions"):
        coverage.select_partitions(parts, "yellow", 2014, require=True)
