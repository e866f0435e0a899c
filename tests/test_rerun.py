"""A re-run reads raw trips whose join is made once, and a write shuffles no column that follows from others."""

import os
import shutil
from datetime import datetime

import pytest

from tollgate.operators.normalize import following_columns, normalize
from tollgate.plans import registry_tables
from tollgate.session import checkpoint_root
from tollgate.sources import adapters, tables

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz")


@pytest.fixture()
def small(spark, tmp_path):
    """Order 2 twice, order 4 without a date; lines of no order, of no key, and of seven passengers."""
    day, folder = datetime(1996, 2, 28), str(tmp_path / "small")
    orders = [(1, day), (2, day), (2, day), (3, datetime(1997, 1, 1)), (4, None)]
    kinds = [(1, 10.0, datetime(1996, 3, 2)), (2, 20.0, day), (3, 0.0, None), (4, None, datetime(1998, 1, 1, 0, 0, 30)), (7, 5.0, day)]
    lines = [(k, 300, 7, n, 1.5, price, 0.05, 0.02, "R" if n == 2 else None, ship)
             for k in (1, 2, 3, 4, None, 9) for n, price, ship in kinds]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("dataset", ["yellow", "green"])
def test_staged_raw_trips_are_the_raw_trips(spark, small, dataset):
    plain = adapters.raw_trips(spark, small, dataset)
    with adapters.staged_raw_trips(spark, small, dataset) as staged:
        assert staged.dtypes == plain.dtypes
        assert _rows(staged) == _rows(plain) != []


def test_rerun_joins_the_raw_trips_once_and_writes_them_twice(spark, small, monkeypatch):
    overwrite, written = tables.overwrite_partitions, []

    def then_without_inputs(df, target, *args, **kwargs):
        overwrite(df, target, *args, **kwargs)
        written.append(df.count())
        shutil.rmtree(f"{small}/orders.parquet", ignore_errors=True)

    monkeypatch.setattr(tables, "overwrite_partitions", then_without_inputs)
    got = registry_tables._rerun(spark, small, "green").collect()
    # Four lines of up to six passengers for each of the two orders 2, and for order 4, whose month is unknown.
    assert written == [12, 12]
    assert {(r.year, r.month, r.records_first, r.records_second) for r in got if r.year} == {(1996, 2, 8, 8)}
    left = f"{checkpoint_root(spark).removeprefix('file:')}/tollgate"
    assert not [f for f in os.listdir(left) if f.startswith("trip-lines-")]


@pytest.mark.parametrize("dataset", ["yellow", "green"])
def test_write_derives_following_columns_after_the_shuffle(spark, small, tmp_path, dataset):
    silver = normalize(adapters.raw_trips(spark, small, dataset), dataset)
    following = following_columns(dataset)
    assert list(following) == ["trip_duration_min", "is_valid_trip", "has_tip", "tip_ratio"]
    out = tables.clustered_for_write(silver, ["year", "month"], ["pickup_ts"], following=following)
    shuffled = out._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    assert "pickup_ts" in shuffled and not [c for c in following if c in shuffled]
    assert out.dtypes == silver.dtypes and _rows(out) == _rows(silver) != []
    target = str(tmp_path / "silver")
    tables.overwrite_partitions(silver, target, ["year", "month"], ["pickup_ts"], following=following)
    stored = tables.read_table(spark, target)
    assert dict(stored.dtypes) == dict(silver.dtypes)
    assert _rows(stored.select(*silver.columns)) == _rows(silver)
