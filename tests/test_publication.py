"""Claims on months, and slices that change as a whole or not at all."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lakefix import month_rows, write_month_file
from tallyhouse.plans import jobs as J
from tallyhouse.sinks import claims, snapshots
from tallyhouse.sinks import writers as K
from tallyhouse.sources import files
from tallyhouse.streaming import file_arrival as A


def test_claims(spark, scratch):
    at = os.path.join(scratch, "c")
    one = claims.acquire(spark, at, "one")
    assert one and claims.acquire(spark, at, "two") is None
    assert claims.acquire(spark, at, "one") == one            # its own again
    claims.release(spark, one)
    two = claims.acquire(spark, at, "two", lease=-1)          # a lease that has ended: free for others
    assert two.number == one.number + 1
    three = claims.acquire(spark, at, "three")
    assert three.number == two.number + 1
    claims.release_owned(spark, at, "two")                    # not the holder any more
    assert claims.acquire(spark, at, "four") is None
    with pytest.raises(ValueError):
        with claims.held(spark, os.path.join(scratch, "d"), "x") as c:
            assert c
            raise ValueError
    assert claims.acquire(spark, os.path.join(scratch, "d"), "y")


def test_one_of_many_gets_the_claim(spark, scratch):
    got, at = [], os.path.join(scratch, "race")
    threads = [threading.Thread(target=lambda k=k: got.append(claims.acquire(spark, at, f"t{k}"))) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(got) == 12 and sum(c is not None for c in got) == 1


def _two_loaders(spark, lake, monkeypatch, first, second):
    """Start ``second`` while ``first`` is between its count and its insert."""
    started, go = threading.Event(), threading.Event()
    write = K.overwrite_slice

    def slow(*a, **k):
        started.set()
        assert go.wait(120)
        return write(*a, **k)
    monkeypatch.setattr(K, "overwrite_slice", slow)
    out = {}
    t = threading.Thread(target=lambda: out.update(first=first()))
    t.start()
    assert started.wait(120)
    out["second"] = second()
    go.set()
    t.join(120)
    return out


def test_two_jobs_load_a_month_once(spark, scratch, monkeypatch):
    lake, rows = J.Lake(os.path.join(scratch, "lake")), month_rows(spark, "1995-03")
    key = os.path.join(lake.landing_orders, "orders_1995-03.csv")
    write_month_file(key, rows)
    load = lambda: J.load_month(spark, lake, key=key)
    out = _two_loaders(spark, lake, monkeypatch, load, load)
    assert (out["first"]["status"], out["second"]["status"]) == ("SUCCEEDED", "SKIPPED_EXISTS")
    assert out["first"]["rows_inserted"] == len(rows) and "another loader" in out["second"]["note"]
    assert spark.read.parquet(lake.warehouse("fact_sales")).count() == len(rows)
    assert load()["rows_existing"] == len(rows)


def test_stream_and_replay_load_a_month_once(spark, scratch, monkeypatch):
    lake, rows = J.Lake(os.path.join(scratch, "lake")), month_rows(spark, "1995-03")
    key, status = os.path.join(lake.landing_orders, "orders_1995-03.csv"), os.path.join(scratch, "status")
    write_month_file(key, rows)
    batch = lambda n: A.load_batch(spark.createDataFrame([(f"file:{key}",)], "path string"), n,
                                   lake.warehouse("fact_sales"), status, "q")
    out = _two_loaders(spark, lake, monkeypatch, lambda: J.load_month(spark, lake, key=key), lambda: batch(0))
    assert out["first"]["status"] == "SUCCEEDED"
    assert [r["status"] for r in spark.read.parquet(status).collect()] == ["SKIPPED_EXISTS"]
    assert spark.read.parquet(lake.warehouse("fact_sales")).count() == len(rows)


def test_a_failed_load_gives_its_claim_back(spark, scratch):
    lake, rows = J.Lake(os.path.join(scratch, "lake")), month_rows(spark, "1995-03")
    key = os.path.join(lake.landing_orders, "orders_1995-03.csv")
    assert J.load_month(spark, lake, key=key)["status"] == "ERROR"            # there is no such file yet
    write_month_file(key, rows)
    assert J.load_month(spark, lake, key=key)["status"] == "SUCCEEDED"


def _values(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("m", "v").collect())


def test_a_writer_that_fails_leaves_the_old_slice(spark, scratch):
    p = os.path.join(scratch, "silver")
    K.write_silver(spark.range(3).select(F.col("id").alias("v")), p, {"m": 1})
    broken = spark.range(6).select(F.when(F.col("id") == 5, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception, match="killed"):
        K.write_silver(broken, p, {"m": 1})
    assert _values(spark, p) == [(1, 0), (1, 1), (1, 2)]
    with pytest.raises(Exception, match="killed"):
        K.overwrite_slice(broken.withColumn("m", F.lit(1)), p, ["m"], [{"m": 1}, {"m": 2}])
    assert _values(spark, p) == [(1, 0), (1, 1), (1, 2)]


@pytest.mark.parametrize("at", range(5))
def test_a_writer_killed_between_renames(spark, scratch, monkeypatch, at):
    """Two slices change together: before the journal not at all; after it,
    the next reader or writer finishes what the dead writer began."""
    p, names = os.path.join(scratch, "t"), [{"m": 1}, {"m": 2}]
    old = spark.createDataFrame([(1, 10), (2, 20)], "m int, v int")
    new = spark.createDataFrame([(1, 11)], "m int, v int")               # month 2 has no rows any more
    K.overwrite_slice(old, p, ["m"], names)
    calls, rename = [], files.rename

    def dying(*a):
        calls.append(a)
        if len(calls) > at:
            raise SystemExit
        rename(*a)
    with monkeypatch.context() as m:
        m.setattr(files, "rename", dying)
        if at < 4:
            with pytest.raises(SystemExit):
                K.overwrite_slice(new, p, ["m"], names)
        else:
            K.overwrite_slice(new, p, ["m"], names)
    snapshots.recover(spark, p)
    assert _values(spark, p) == [(1, 11)]
    assert [n for n in files.children(spark, f"{p}/_swap")] == []


def test_killed_before_the_journal(spark, scratch, monkeypatch):
    p = os.path.join(scratch, "t")
    K.write_silver(spark.range(2).select(F.col("id").alias("v")), p, {"m": 1})
    with monkeypatch.context() as m:
        m.setattr(files, "put_text", lambda *a: (_ for _ in ()).throw(SystemExit()))
        with pytest.raises(SystemExit):
            K.write_silver(spark.range(9).select(F.col("id").alias("v")), p, {"m": 1})
    snapshots.recover(spark, p)
    assert _values(spark, p) == [(1, 0), (1, 1)]
    assert len(files.children(spark, f"{p}/_swap")) == 1                  # may still be at work: kept for a day
    monkeypatch.setattr(snapshots, "KEEP_SECONDS", -1)
    snapshots.recover(spark, p)
    assert files.children(spark, f"{p}/_swap") == []


def test_lost_slice_is_ingested_again(spark, scratch):
    """The slice decides, not the log."""
    lake, src = J.Lake(os.path.join(scratch, "lake")), os.path.join(scratch, "orders.csv")
    write_month_file(src, month_rows(spark, "1995-03"))
    ingest = lambda: [(r["status"], r["rows"]) for r in J.ingest_orders(
        spark, src, lake, ["1995-03", "1970-01"], date_format=None)]
    first = ingest()
    assert first[0][0] == "SUCCEEDED" and first[0][1] > 0 and first[1] == ("SUCCEEDED", 0)
    assert {s for s, _ in ingest()} == {"SKIPPED_EXISTS"}
    files.delete(spark, f"{lake.bronze_orders}/year=1995/month=3")
    assert sorted(ingest()) == sorted([("SUCCEEDED", first[0][1]), ("SKIPPED_EXISTS", 0)])
    assert J.present_months(spark, lake.bronze_orders, ["1995-03", "1970-01"]) == {"1995-03", "1970-01"}
