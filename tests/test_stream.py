"""File-arrival fact loading (I1) with a checkpointed Structured Streaming query."""

import os

from pyspark.sql import functions as F

from lakefix import month_rows, write_month_file
from tallyhouse.streaming.file_arrival import load_batch, start_fact_stream


def _run(spark, landing, fact, status, ckpt, per_trigger=None):
    q = start_fact_stream(spark, landing, fact, status, ckpt, max_files_per_trigger=per_trigger)
    q.awaitTermination(300)
    assert q.exception() is None


def _statuses(spark, status):
    return sorted((os.path.basename(r["file_path"]), r["status"], r["rows_inserted"])
                  for r in spark.read.parquet(status).collect())


def test_stream_loads_each_file_once(spark, scratch):
    landing, fact = os.path.join(scratch, "landing"), os.path.join(scratch, "fact")
    status, ckpt = os.path.join(scratch, "status"), os.path.join(scratch, "ckpt")
    m3, m4 = month_rows(spark, "1995-03"), month_rows(spark, "1995-04")
    write_month_file(os.path.join(landing, "orders_1995-03.csv"), m3)
    write_month_file(os.path.join(landing, "orders_1995-04.csv"), m4)
    write_month_file(os.path.join(landing, "x_orders_1995-04.csv"), m4[:5])   # same month, later path
    write_month_file(os.path.join(landing, "notes.csv"), m4[:2])              # bad name
    _run(spark, landing, fact, status, ckpt)
    counts = {r["RunMonth"]: r["n"] for r in spark.read.parquet(fact).groupBy("RunMonth")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"1995-03": len(m3), "1995-04": len(m4)}
    assert _statuses(spark, status) == sorted([
        ("orders_1995-03.csv", "SUCCEEDED", len(m3)), ("orders_1995-04.csv", "SUCCEEDED", len(m4)),
        ("x_orders_1995-04.csv", "SKIPPED_EXISTS", 0), ("notes.csv", "IGNORED_BAD_NAME", 0)])

    # restart: seen files are not read again; a new month and a late copy arrive
    m5 = month_rows(spark, "1995-05")
    write_month_file(os.path.join(landing, "orders_1995-05.csv"), m5)
    write_month_file(os.path.join(landing, "y_orders_1995-03.csv"), m3[:3])
    _run(spark, landing, fact, status, ckpt, per_trigger=1)      # one file per micro-batch
    counts = {r["RunMonth"]: r["n"] for r in spark.read.parquet(fact).groupBy("RunMonth")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"1995-03": len(m3), "1995-04": len(m4), "1995-05": len(m5)}
    st = _statuses(spark, status)
    assert ("orders_1995-05.csv", "SUCCEEDED", len(m5)) in st
    assert ("y_orders_1995-03.csv", "SKIPPED_EXISTS", 0) in st
    assert len(st) == 6

    # a third run with nothing new changes nothing
    _run(spark, landing, fact, status, ckpt)
    assert spark.read.parquet(fact).count() == len(m3) + len(m4) + len(m5)


def _batch(spark, *paths):
    return spark.createDataFrame([(f"file:{p}",) for p in paths], "path string")


def test_replayed_batch_is_idempotent(spark, scratch):
    """foreachBatch may run an epoch again after a failure: no duplicate rows,
    and the recorded decisions stand."""
    fact, status = os.path.join(scratch, "fact"), os.path.join(scratch, "status")
    rows = month_rows(spark, "1995-03")
    p = os.path.join(scratch, "landing", "orders_1995-03.csv")
    write_month_file(p, rows)
    for _ in range(2):
        load_batch(_batch(spark, p), 0, fact, status, "query-a")
        assert spark.read.parquet(fact).count() == len(rows)
        assert _statuses(spark, status) == [("orders_1995-03.csv", "SUCCEEDED", len(rows))]


def test_new_checkpoint_on_an_old_status_path(spark, scratch):
    """A new query starts at batch 0 again; its files are decided anew."""
    landing, fact = os.path.join(scratch, "landing"), os.path.join(scratch, "fact")
    status = os.path.join(scratch, "status")
    m3, m4 = month_rows(spark, "1995-03"), month_rows(spark, "1995-04")
    write_month_file(os.path.join(landing, "orders_1995-03.csv"), m3)
    _run(spark, landing, fact, status, os.path.join(scratch, "ckpt-a"))
    write_month_file(os.path.join(landing, "orders_1995-04.csv"), m4)
    _run(spark, landing, fact, status, os.path.join(scratch, "ckpt-b"))
    assert spark.read.parquet(fact).count() == len(m3) + len(m4)
    assert _statuses(spark, status) == sorted([
        ("orders_1995-03.csv", "SUCCEEDED", len(m3)), ("orders_1995-03.csv", "SKIPPED_EXISTS", 0),
        ("orders_1995-04.csv", "SUCCEEDED", len(m4))])
    assert spark.read.parquet(status).where("query_id = 'manual'").count() == 0


def test_unreadable_and_empty_files_beside_good_ones(spark, scratch):
    """One status row per file; a file that yields nothing leaves its month to a later one."""
    landing, fact = os.path.join(scratch, "landing"), os.path.join(scratch, "fact")
    status = os.path.join(scratch, "status")
    m3, m4 = month_rows(spark, "1995-03"), month_rows(spark, "1995-04")
    good, empty = os.path.join(landing, "orders_1995-03.csv"), os.path.join(landing, "orders_1995-04.csv")
    later, gone = os.path.join(landing, "z_orders_1995-04.csv"), os.path.join(landing, "orders_1995-05.csv")
    write_month_file(good, m3)
    write_month_file(empty, [])                       # a header only
    write_month_file(later, m4)
    load_batch(_batch(spark, good, empty, later, gone), 0, fact, status, "q")     # gone: vanished since it was seen
    assert spark.read.parquet(fact).count() == len(m3) + len(m4)
    assert _statuses(spark, status) == sorted([
        ("orders_1995-03.csv", "SUCCEEDED", len(m3)), ("orders_1995-04.csv", "SKIPPED_EMPTY_FILE", 0),
        ("z_orders_1995-04.csv", "SUCCEEDED", len(m4)), ("orders_1995-05.csv", "ERROR", 0)])
    error = spark.read.parquet(status).where("status = 'ERROR'").first()["error"]
    assert "orders_1995-05.csv" in error
    # the month comes again later and loads
    write_month_file(gone, month_rows(spark, "1995-05"))
    load_batch(_batch(spark, gone), 1, fact, status, "q")
    assert {r["RunMonth"] for r in spark.read.parquet(fact).select("RunMonth").distinct().collect()} == {
        "1995-03", "1995-04", "1995-05"}


def test_stream_sees_empty_files(spark, scratch):
    landing, status = os.path.join(scratch, "landing"), os.path.join(scratch, "status")
    write_month_file(os.path.join(landing, "orders_1995-03.csv"), [])
    with open(os.path.join(landing, "orders_1995-04.csv"), "w"):
        pass
    _run(spark, landing, os.path.join(scratch, "fact"), status, os.path.join(scratch, "ckpt"))
    assert _statuses(spark, status) == [("orders_1995-03.csv", "SKIPPED_EMPTY_FILE", 0),
                                        ("orders_1995-04.csv", "SKIPPED_EMPTY_FILE", 0)]
