"""Partial sums, logs, catalog partitions, malformed lines, the calendar from
partition names and the archive of loaded files."""

import os

import pytest
from pyspark.sql import functions as F

from lakefix import month_rows, write_month_file
from tallyhouse.operators import measures as M
from tallyhouse.operators import rollups as R
from tallyhouse.operators import views as V
from tallyhouse.operators import warehouse as W
from tallyhouse.plans import jobs as J
from tallyhouse.sinks import writers as K
from tallyhouse.sources import files
from tallyhouse.streaming.file_arrival import start_fact_stream

MONTHS = ["1995-03", "1995-04", "1995-05"]


def _land(spark, lake, m, rows=None):
    key = os.path.join(lake.landing_orders, f"orders_{m}.csv")
    write_month_file(key, month_rows(spark, m) if rows is None else rows)
    return key


@pytest.fixture()
def lake(spark, scratch):
    return J.Lake(os.path.join(scratch, "lake"))


@pytest.fixture(scope="module")
def dims(spark):
    from conftest import SF_SMALL
    from tallyhouse.plans.queries import _silver_dims
    return {k: v.cache() for k, v in _silver_dims(spark, SF_SMALL).items()}


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _check_measures(spark, lake, d):
    fact = W.read_warehouse(spark, lake.warehouse("fact_sales"), "fact_sales")
    p = J.read_rollups(spark, lake)
    for name in R.TABLES:
        assert _rows(p[name]) == _rows(R.partials(fact)[name]), name
    both = [(R.total_sales, M.total_sales, ()), (R.total_sales_header, M.total_sales_header, ()),
            (R.units_sold, M.units_sold, ()), (R.gross_margin, M.gross_margin, (d["product"],)),
            (R.margin_by_country, M.margin_by_country, (d["employee"], d["product"])),
            (R.sales_by_month_country, M.sales_by_month_country, (d["employee"],)),
            (R.cumulative_sales, M.cumulative_sales, (d["employee"],)),
            (R.budget_compliance, M.budget_compliance, (d["store"],)),
            (R.store_compliance_bands, M.store_compliance_bands, (d["store"],)),
            (R.store_diversity, M.store_diversity, (d["store"],))]
    for from_partials, from_fact, args in both:
        assert _rows(from_partials(p, *args)) == _rows(from_fact(fact, *args)), from_fact.__name__


def test_partials_follow_load_rerun_and_backfill(spark, lake, dims):
    for m in MONTHS[1:]:
        assert J.load_month(spark, lake, key=_land(spark, lake, m))["status"] == "SUCCEEDED"
    _check_measures(spark, lake, dims)
    assert J.refresh_rollups(spark, lake) == []                       # nothing changed
    # a rerun of one month with fewer rows replaces its partials alone
    other = files.newest(spark, K.slice_path(lake.rollup("store"), {"RunMonth": MONTHS[2]}))
    files.delete(spark, K.slice_path(lake.warehouse("fact_sales"), {"RunMonth": MONTHS[1]}))
    J.load_month(spark, lake, key=_land(spark, lake, MONTHS[1], month_rows(spark, MONTHS[1])[:7]))
    _check_measures(spark, lake, dims)
    assert files.newest(spark, K.slice_path(lake.rollup("store"), {"RunMonth": MONTHS[2]})) == other
    # a backfill by the stream, which knows nothing of partials, is found and caught up with
    landing = lake.landing_orders + "2"
    write_month_file(os.path.join(landing, f"orders_{MONTHS[0]}.csv"), month_rows(spark, MONTHS[0]))
    q = start_fact_stream(spark, landing, lake.warehouse("fact_sales"), lake.load_status, lake.root + "_ckpt")
    q.awaitTermination(300)
    assert J.refresh_rollups(spark, lake) == [MONTHS[0]]
    _check_measures(spark, lake, dims)


def test_logs_stay_few_files(spark, lake, monkeypatch):
    monkeypatch.setattr(K, "LOG_FILES", 6)
    for k in range(1, 26):
        K.log_control(spark, lake.control, [{"run_id": f"r{k}", "run_month": f"{2011 + k // 12}-{k % 12 + 1:02d}",
                                             "source": "github", "table": "orders", "status": "SUCCEEDED", "records_out": k}])
    log = K.read_log(spark, lake.control, K.CONTROL_SCHEMA)
    assert log.columns == K.CONTROL_SCHEMA.names and sorted(r.records_out for r in log.collect()) == list(range(1, 26))
    held = [n for s in files.partitions(spark, lake.control, ["log_month"])
            for n in files.children(spark, K.slice_path(lake.control, s)) if n.startswith("part")]
    assert len(held) <= 2 * (K.LOG_FILES + 1)                         # two months at most, if the clock passed one
    assert J.next_month_job(spark, lake, "2011-05", "2014-05")["candidate"] == "2013-03"
    assert K.read_log(spark, lake.errors, K.ERROR_SCHEMA).count() == 0


def test_loaded_month_is_visible_by_sql(spark, lake, monkeypatch):
    J.load_month(spark, lake, key=_land(spark, lake, MONTHS[0]))
    assert J.register_tables(spark, lake, "upkeep") == ["fact_sales"]
    count = lambda: {r.RunMonth: r.n for r in spark.sql(
        "SELECT RunMonth, count(*) AS n FROM upkeep.fact_sales GROUP BY RunMonth").collect()}
    first = count()
    assert set(first) == {MONTHS[0]}
    statements, run = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: statements.append(q) or run(self, q, *a, **k))
    out = J.load_month(spark, lake, key=_land(spark, lake, MONTHS[1]), catalog="upkeep")
    assert count() == first | {MONTHS[1]: out["rows_inserted"]}
    assert [q for q in statements if "PARTITION" in q] == [
        f"ALTER TABLE upkeep.fact_sales ADD IF NOT EXISTS PARTITION (RunMonth='{MONTHS[1]}') LOCATION "
        f"'{lake.warehouse('fact_sales')}/RunMonth={MONTHS[1]}'"]
    run(spark, "DROP DATABASE upkeep CASCADE")


def test_calendar_without_the_fact_and_pruning(spark, lake):
    for m in ["1995-03", "1995-04", "1995-06", "1995-08"]:
        J.load_month(spark, lake, key=_land(spark, lake, m))
    calendar = V.v_calendar_month_loaded(J.loaded_months(spark, lake))
    assert sorted(r.YearMonth for r in calendar.collect()) == ["1995-03", "1995-04", "1995-06", "1995-08"]
    assert "FileScan" not in calendar._jdf.queryExecution().executedPlan().toString()
    fact = W.read_warehouse(spark, lake.warehouse("fact_sales"), "fact_sales")
    quarter = M.total_sales(V.of_months(fact, calendar.where("Year = 1995 AND Quarter = 2")))
    assert sorted(r.RunMonth for r in quarter.collect()) == ["1995-04", "1995-06"]
    assert "dynamicpruning" in quarter._jdf.queryExecution().executedPlan().toString()


HEAD = ("SalesOrderID,SalesOrderDetailID,OrderDate,DueDate,ShipDate,EmployeeID,CustomerID,SubTotal,TaxAmt,Freight,"
        "TotalDue,ProductID,OrderQty,UnitPrice,UnitPriceDiscount,LineTotal,StoreID")
GOOD = "{},1,{},6/1/2011,6/2/2011,1,2,10,0.5,10,20.5,3,2,5,0,10,4"


def test_malformed_lines_are_quarantined(spark, lake, scratch):
    src = os.path.join(scratch, "orders.csv")
    may, june = GOOD.format(1, "5/1/2011"), GOOD.format(2, "6/1/2011")
    long, short, none = GOOD.format(3, "5/2/2011") + ",extra", "4,1,5/3/2011,x", "garbage"
    with open(src, "w") as fh:
        fh.write("\n".join([HEAD, may, june, long, short, none, GOOD.format(5, "6/9/2011") + ",,"]) + "\n")
    res = J.ingest_orders(spark, src, lake, ["2011-05"], date_format=None)
    assert [(r["status"], r["rows"]) for r in res] == [("SUCCEEDED", 1)]
    lines = lambda: sorted((r.run_month, r.line, r.REASON) for r in spark.read.parquet(
        lake.invalid("ingest_orders_lines")).collect())
    want = [("2011-05", long, "MALFORMED_LINE"), ("2011-05", short, "MALFORMED_LINE"), ("unknown", none, "MALFORMED_LINE")]
    assert lines() == sorted(want)
    J.ingest_orders(spark, src, lake, ["2011-06"], date_format=None)
    assert lines() == sorted(want + [("2011-06", GOOD.format(5, "6/9/2011") + ",,", "MALFORMED_LINE")])
    # a bronze file that others landed
    with open(f"{lake.bronze_orders}/year=2011/month=5/extra.csv", "w") as fh:
        fh.write("\n".join([HEAD, GOOD.format(9, "5/9/2011"), long, short]) + "\n")
    out = J.bronze_to_silver(spark, lake, "2011-05")
    assert out["orders"] == {"valid": 2, "invalid": 0} and out["orders_lines"] == {"malformed": 2}
    assert sorted(r.line for r in spark.read.parquet(lake.invalid("orders_lines")).collect()) == sorted([long, short])
    # a month of nothing but such lines
    J.ingest_orders(spark, src, lake, ["2011-07"], date_format=None)
    with open(f"{lake.bronze_orders}/year=2011/month=7/extra.csv", "w") as fh:
        fh.write("\n".join([HEAD, long, short]) + "\n")
    out = J.bronze_to_silver(spark, lake, "2011-07")
    assert out["orders"] == {"valid": 0, "invalid": 0} and out["orders_lines"] == {"malformed": 2}
    os.remove(f"{lake.bronze_orders}/year=2011/month=7/extra.csv")
    J.bronze_to_silver(spark, lake, "2011-07")
    os.remove(f"{lake.bronze_orders}/year=2011/month=5/extra.csv")
    assert "orders_lines" not in J.bronze_to_silver(spark, lake, "2011-05")
    assert spark.read.parquet(lake.invalid("orders_lines")).count() == 0


def test_loaded_files_are_archived(spark, lake, scratch):
    landing, archive = lake.landing_orders, os.path.join(scratch, "archive")

    def run():
        q = start_fact_stream(spark, landing, lake.warehouse("fact_sales"), lake.load_status, lake.root + "_ckpt",
                              max_files_per_trigger=1, archive_dir=archive)
        q.awaitTermination(300)
        assert q.exception() is None
    for k, m in enumerate(MONTHS):
        _land(spark, lake, m)
        if k == 1:
            open(os.path.join(landing, "orders_1995-09.csv"), "w").close()
        run()
    _land(spark, lake, "1995-06")
    run()
    left = [n for n in files.children(spark, landing) if not n.startswith(".")]
    assert set(left) <= {f"orders_{MONTHS[2]}.csv", "orders_1995-06.csv"}    # the last batches' files at most
    moved = {n for _, _, names in os.walk(archive) for n in names}
    assert {f"orders_{MONTHS[0]}.csv", f"orders_{MONTHS[1]}.csv"} <= moved and any("1995-09" in n for n in moved)
    status = sorted((os.path.basename(r.file_path), r.status) for r in spark.read.parquet(lake.load_status).collect())
    assert status == sorted([(f"orders_{m}.csv", "SUCCEEDED") for m in [*MONTHS, "1995-06"]] +
                            [("orders_1995-09.csv", "SKIPPED_EMPTY_FILE")])
    fact = spark.read.parquet(lake.warehouse("fact_sales")).groupBy("RunMonth").agg(F.count(F.lit(1)).alias("n"))
    assert {r.RunMonth: r.n for r in fact.collect()} == {m: len(month_rows(spark, m)) for m in [*MONTHS, "1995-06"]}
