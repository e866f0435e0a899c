"""Month files whose types, names and presence drift."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import types as T

from tollgate.sources import drift, files


def test_promotions():
    p = drift.promote
    assert p(T.IntegerType(), T.LongType()) == p(T.LongType(), T.ByteType()) == T.LongType()
    assert p(T.LongType(), T.DoubleType()) == p(T.FloatType(), T.IntegerType()) == p(T.DecimalType(9, 2), T.DoubleType()) == T.DoubleType()
    assert p(T.FloatType(), T.ShortType()) == T.FloatType() and p(T.NullType(), T.DateType()) == T.DateType()
    assert p(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4) and p(T.DecimalType(5, 2), T.IntegerType()) == T.DecimalType(12, 2)
    assert p(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and p(T.StringType(), T.LongType()) == T.StringType()
    a, b = T.StructType([T.StructField("x", T.IntegerType())]), T.StructType([T.StructField("X", T.LongType()), T.StructField("y", T.StringType())])
    assert [(f.name, f.dataType) for f in p(a, b).fields] == [("x", T.LongType()), ("y", T.StringType())]
    assert p(T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())) == T.ArrayType(T.DoubleType())
    for x, y in ((T.BooleanType(), T.LongType()), (T.ArrayType(T.LongType()), T.StringType()), (T.DateType(), T.LongType())):
        with pytest.raises(drift.DriftError, match="col"):
            p(x, y, "col")


def land(spark, base, name, rows, schema, year=2014):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{year}/{name}")


def test_months(spark, tmp_path):
    base = str(tmp_path / "raw data")
    ts = dt.datetime(2014, 1, 5)
    land(spark, base, "green_tripdata_2014-01.parquet", [(1, ts, 1)], "passengers int, at timestamp, RatecodeID int")
    land(spark, base, "green_tripdata_2014-02.parquet", [(2 ** 40, ts, 2.5)], "passengers long, at timestamp, RateCodeID double")
    land(spark, base, "green_tripdata_2014-04.parquet", [(1.5, decimal.Decimal("3.25"), "x")], "passengers double, RatecodeID decimal(5,2), more string")
    land(spark, base, "green_tripdata_2014-05.parquet", [(7, ts, 1)], "passengers int, at timestamp, RatecodeID int")
    os.makedirs(f"{base}/2014/green_tripdata_2014-06.parquet")
    with open(f"{base}/2014/green_tripdata_2014-06.parquet/part-0.parquet", "wb") as f:
        f.write(b"PAR1 not a file PAR1")
    rows, inventory = files.scan_months(spark, base, "green", [(2014, m) for m in range(1, 8)])
    assert {r["month"]: r["status"] for r in inventory.collect()} == {1: "present", 2: "present", 3: "missing", 4: "present", 5: "present", 6: "unreadable", 7: "missing"}
    assert inventory.where("status = 'unreadable' AND error IS NOT NULL").count() == 1
    assert dict(rows.dtypes) == {"passengers": "double", "at": "timestamp", "RatecodeID": "double", "more": "string", "file_year": "int", "file_month": "int"}
    got = {(r["file_year"], r["file_month"], r["passengers"], r["at"], r["RatecodeID"], r["more"]) for r in rows.collect()}
    assert got == {(2014, 1, 1.0, ts, 1.0, None), (2014, 2, 2.0 ** 40, ts, 2.5, None), (2014, 4, 1.5, None, 3.25, "x"), (2014, 5, 7.0, ts, 1.0, None)}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3  # one scan per schema
    with pytest.raises(FileNotFoundError, match=r"2014-06 \(unreadable\)"):
        files.scan_month_files(spark, base, "green", [(2014, 5), (2014, 6)], missing_ok=False)
    assert files.scan_month_files(spark, base, "green", [(2014, 5), (2014, 6)]).count() == 1
    none, missing = files.scan_months(spark, base, "yellow", [(2014, 1)])
    assert none is None and missing.collect()[0]["status"] == "missing"
    with pytest.raises(OSError, match="1 files can't be read"):
        files.scan_glob(spark, base, "*.parquet")


def test_one_schema_is_one_scan(spark, tmp_path):
    for m in (1, 2):
        land(spark, str(tmp_path), f"green_tripdata_2014-0{m}.parquet", [(m, "a")], "v int, t string")
    plan = files.scan_glob(spark, str(tmp_path), "*.parquet").where("v > 1").select("t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [IsNotNull(v), GreaterThan(v,1)]" in plan and "Union" not in plan
