"""Incremental ingest: replayed batches, crashes before settling, failing months that are tried again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_tables_files import raw_green, row
from tollgate.sources import files, tables
from tollgate.streaming import ingest

JAN, FEB = dt.datetime(2014, 1, 3), dt.datetime(2014, 2, 2)


def landing(spark, tmp_path, vendor_of_feb=1):
    raw = raw_green(spark, [row(t, t + dt.timedelta(minutes=k)) for t in (JAN, FEB) for k in (5, 7)]).withColumn(
        "VendorID", F.when(F.month("lpep_pickup_datetime") == 2, vendor_of_feb).otherwise(F.col("VendorID")))
    landed = raw.withColumn("year", F.year("lpep_pickup_datetime")).withColumn("month", F.month("lpep_pickup_datetime"))
    return landed, raw.schema, {k: str(tmp_path / k) for k in ("landing", "silver", "gold", "quality", "ckpt")}


def run(spark, schema, wh):
    ingest.ingest_available(spark, wh["landing"], schema, "green", wh["silver"], wh["gold"], wh["ckpt"], wh["quality"], files_per_trigger=1)
    return ingest.Ledger(spark, wh["ckpt"] + "-ledger")


def audit(spark, wh):
    return sorted((r.month, r.dag_run_id, r.check_name, r.status) for r in tables.read_table(spark, wh["quality"]).collect())


def test_months_are_rebuilt_once_and_replays_change_nothing(spark, tmp_path, monkeypatch):
    landed, schema, wh = landing(spark, tmp_path)
    for part in landed.randomSplit([1.0, 1.0, 1.0], 4):  # files of a month come in several batches
        part.write.mode("append").partitionBy("year", "month").parquet(wh["landing"])
    rebuilt = []
    real = ingest.rebuild_months
    monkeypatch.setattr(ingest, "rebuild_months", lambda s, months, *a, **k: rebuilt.append([m[:2] for m in months]) or real(s, months, *a, **k))
    book = run(spark, schema, wh)
    assert rebuilt == [[(2014, 1), (2014, 2)]] and book.pending("green") == []
    rows, gold = audit(spark, wh), sorted((r.month, r.trip_count) for r in tables.read_table(spark, wh["gold"]).collect())
    assert gold == [(1, 2), (2, 2)] and len({r[1] for r in rows}) == 2
    # Nothing new: no rebuild.  A replayed micro-batch: the same arrivals, nothing pending.
    run(spark, schema, wh)
    arrivals = book._read(book.arrivals, ingest.ARRIVALS)
    n = arrivals.count()
    book.arrived(spark.createDataFrame([("file:/x/year=2014/month=1/a.parquet",), ("file:/x/other.parquet",)], "path string"), 0, "green")
    assert len(rebuilt) == 1 and book._read(book.arrivals, ingest.ARRIVALS).count() <= n and book.pending("green") == [] and audit(spark, wh) == rows
    # A crash after the sinks and before the ledger: the months are done again and leave no second audit row.
    landed.where("month = 2").write.mode("append").partitionBy("year", "month").parquet(wh["landing"])
    monkeypatch.setattr(ingest.Ledger, "settle", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        run(spark, schema, wh)
    once = audit(spark, wh)
    monkeypatch.undo()
    run(spark, schema, wh)
    assert audit(spark, wh) == once and len({r[1] for r in once}) == 3 and book.pending("green") == []
    assert sorted((r.month, r.trip_count) for r in tables.read_table(spark, wh["gold"]).collect()) == [(1, 2), (2, 4)]


def test_unreadable_month_is_tried_again(spark, tmp_path):
    landed, schema, wh = landing(spark, tmp_path)
    files.land_raw(landed, wh["landing"])
    part = next((tmp_path / "landing/year=2014/month=2").glob("*.parquet"))
    good = part.read_bytes()
    part.write_bytes(b"PAR1" + b"\xff" * (len(good) - 8) + b"PAR1")
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    book = run(spark, schema, wh)
    assert [(r.month, r.attempt) for r in book.retry_list("green").collect()] == [(2, 0)] and "read error" in book.retry_list("green").first().error
    assert [r.month for r in tables.read_table(spark, wh["gold"]).collect()] == [1]
    assert [(m, c, s) for m, _, c, s in audit(spark, wh) if m == 2] == [(2, "silver_partition_read", "fail")]
    part.write_bytes(good)
    book = run(spark, schema, wh)
    assert book.retry_list("green").isEmpty() and [(r.month, r.status, r.attempt) for r in book.last("green").orderBy("month").collect()] == [(1, "done", 0), (2, "done", 1)]
    assert sorted(r.month for r in tables.read_table(spark, wh["gold"]).collect()) == [1, 2]


def test_gated_month_stays_on_the_retry_list(spark, tmp_path):
    landed, schema, wh = landing(spark, tmp_path, vendor_of_feb=99)
    files.land_raw(landed, wh["landing"])
    for attempt in range(2):
        book = run(spark, schema, wh)
        assert [(r.month, r.attempt, r.error) for r in book.retry_list("green").collect()] == [(2, attempt, "hard quality failure")]
    assert [r.month for r in tables.read_table(spark, wh["gold"]).collect()] == [1]


def test_only_read_errors_are_a_months_fault(spark, tmp_path, monkeypatch):
    landed, schema, wh = landing(spark, tmp_path)
    files.land_raw(landed, wh["landing"])
    monkeypatch.setattr(ingest.quality, "audit", lambda *a, **k: (_ for _ in ()).throw(ValueError("a fault of the code")))
    with pytest.raises(ValueError, match="fault of the code"):
        run(spark, schema, wh)
    assert files.is_read_error(FileNotFoundError("x")) and not files.is_read_error(RuntimeError("ExecutorLostFailure (executor 3 exited)"))
