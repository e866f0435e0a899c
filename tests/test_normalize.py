import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollgate.operators import normalize
from tollgate.schemas import SILVER_GREEN, SILVER_YELLOW

T0 = dt.datetime(2014, 1, 10, 8, 0, 0)


def raw_green(spark, rows):
    return spark.createDataFrame(rows, (
        "VendorID bigint, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
        "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, "
        "tip_amount double, tolls_amount double, total_amount double"))


def raw_yellow(spark, rows):
    return spark.createDataFrame(rows, (
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
        "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, "
        "tip_amount double, tolls_amount double, total_amount double"))


def row(pickup, dropoff, passengers=1, fare=10.0, tip=1.0, tolls=0.0, flag="N"):
    return (1, pickup, dropoff, passengers, 1.5, 1, flag, 10, 20, 1, fare, tip, tolls,
            None if fare is None else fare + (tip or 0) + (tolls or 0))


def test_schemas_exact(spark):
    y = normalize.normalize(raw_yellow(spark, [row(T0, T0 + dt.timedelta(minutes=5))]), "yellow")
    g = normalize.normalize(raw_green(spark, [row(T0, T0 + dt.timedelta(minutes=5))]), "green")
    assert [(f.name, f.dataType) for f in y.schema] == [(f.name, f.dataType) for f in SILVER_YELLOW]
    assert [(f.name, f.dataType) for f in g.schema] == [(f.name, f.dataType) for f in SILVER_GREEN]


def test_thirty_second_trip_differs_by_dataset(spark):
    r = [row(T0, T0 + dt.timedelta(seconds=30))]
    y = normalize.normalize(raw_yellow(spark, r), "yellow").first()
    g = normalize.normalize(raw_green(spark, r), "green").first()
    assert y.trip_duration_min == pytest.approx(0.5)
    assert y.is_valid_trip is True
    assert g.trip_duration_min == 0
    assert g.is_valid_trip is False


def test_negative_and_zero_duration_invalid(spark):
    r = [row(T0, T0 - dt.timedelta(minutes=3)), row(T0, T0)]
    out = normalize.normalize(raw_yellow(spark, r), "yellow").collect()
    assert [x.is_valid_trip for x in out] == [False, False]
    assert out[0].trip_duration_min == pytest.approx(-3.0)


def test_sub_second_timestamps_truncate_to_whole_seconds(spark):
    r = [row(T0.replace(microsecond=900000), T0 + dt.timedelta(seconds=60, microseconds=100000))]
    g = normalize.normalize(raw_green(spark, r), "green").first()
    # whole seconds: 60 - 0 = 60 -> 1 minute
    assert g.trip_duration_min == 1


def test_passenger_filter(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=1), passengers=p) for p in (None, 0, 1, 6, 7)]
    out = normalize.normalize(raw_yellow(spark, rows), "yellow")
    assert sorted(r.passenger_count for r in out.collect()) == [1, 6]


def test_tip_ratio_rules(spark):
    rows = [
        row(T0, T0 + dt.timedelta(minutes=1), fare=10.0, tip=2.5),
        row(T0, T0 + dt.timedelta(minutes=1), fare=0.0, tip=1.0),
        row(T0, T0 + dt.timedelta(minutes=1), fare=None, tip=1.0),
        row(T0, T0 + dt.timedelta(minutes=1), fare=10.0, tip=None),
        row(T0, T0 + dt.timedelta(minutes=1), fare=-10.0, tip=-2.0, tolls=-1.0),
    ]
    out = normalize.normalize(raw_green(spark, rows), "green").collect()
    assert [r.tip_ratio for r in out] == [0.25, 0.0, 0.0, None, 0.0]
    assert [r.has_tip for r in out] == [True, True, True, None, False]


def test_missing_optional_columns_are_typed_nulls(spark):
    out = normalize.normalize(raw_yellow(spark, [row(T0, T0 + dt.timedelta(minutes=1))]), "yellow").first()
    assert out.extra is None and out.airport_fee is None and out.congestion_surcharge is None


def test_store_flag_null_kept(spark):
    out = normalize.normalize(raw_yellow(spark, [row(T0, T0 + dt.timedelta(minutes=1), flag=None)]), "yellow")
    assert out.first().store_and_fwd_flag is None


def test_two_source_variants_coalesce(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "RatecodeID bigint, RateCodeID bigint")
    out = normalize.rename_columns(df, normalize.GREEN_RENAMES)
    assert out.columns == ["rate_code_id"]
    assert [r.rate_code_id for r in out.collect()] == [1, 2]


def test_conform_to_partitions(spark):
    rows = [row(T0, T0 + dt.timedelta(minutes=1)), row(dt.datetime(2013, 12, 31, 23, 0), T0)]
    silver = normalize.normalize(raw_green(spark, rows), "green")
    assert normalize.conform_to_partitions(silver, [(2014, 1)]).count() == 1
    parts = spark.createDataFrame([(2014, 1)], "year int, month int")
    assert normalize.conform_to_partitions(silver, parts).count() == 1


def test_unknown_dataset(spark):
    with pytest.raises(ValueError):
        normalize.normalize(raw_green(spark, [row(T0, T0)]), "fhv")


def test_money_decimal(spark):
    df = spark.createDataFrame([(12.345,)], "fare_amount float")
    out = normalize.money_to_decimal(df).first()
    assert str(out.fare_amount) in ("12.35", "12.34")
    assert normalize.money_to_decimal(df).schema["fare_amount"].dataType.simpleString() == "decimal(10,2)"
