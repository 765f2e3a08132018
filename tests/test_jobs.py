"""End-to-end jobs on a scratch lake: ingest -> silver -> warehouse -> monthly
fact load -> next month; replays change nothing."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakefix import write_month_file, write_sources, month_rows
from tallyhouse.functions import exprs as X
from tallyhouse.operators import clean as C
from tallyhouse.plans import jobs as J
from tallyhouse.sources import fixtures as FX


@pytest.fixture(scope="module")
def lake_env(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    src = write_sources(spark, base)
    return J.Lake(os.path.join(base, "lake")), src


def test_ingest_orders_and_replay(spark, lake_env):
    lake, src = lake_env
    months = ["1995-03", "1995-04"]
    res = J.ingest_orders(spark, src["orders"], lake, months)
    raw = FX.raw_orders(spark, SF_SMALL)
    want = {m: raw.where(X.parsed_month("OrderDate") == m).count() for m in months}
    assert {r["run_month"]: (r["status"], r["rows"]) for r in res} == {
        m: ("SUCCEEDED", want[m]) for m in months}
    again = J.ingest_orders(spark, src["orders"], lake, months)
    assert {r["status"] for r in again} == {"SKIPPED_EXISTS"}
    assert J.present_months(spark, lake.bronze_orders, months + ["1995-09"]) == set(months)
    notes = {(r["run_month"], r["status"]): r["note"] for r in spark.read.parquet(lake.control).collect()}
    assert notes["1995-03", "SUCCEEDED"].startswith("wrote ") and notes["1995-03", "SKIPPED_EXISTS"].endswith("already exists")
    # a month without rows succeeds with 0 rows and is not ingested again
    r = J.ingest_orders(spark, src["orders"], lake, ["1970-01"])[0]
    assert (r["run_month"], r["status"], r["rows"]) == ("1970-01", "SUCCEEDED", 0)
    assert J.ingest_orders(spark, src["orders"], lake, ["1970-01"])[0]["status"] == "SKIPPED_EXISTS"


def test_bronze_to_silver_matches_operator(spark, lake_env):
    lake, src = lake_env
    for t in ("customers", "employees", "stores", "stores_budget", "products",
              "product_subcategories", "product_categories"):
        assert J.ingest_dim_snapshot(spark, t, src[t], lake, "1995-03")["status"] == "SUCCEEDED"
    assert J.ingest_dim_snapshot(spark, "customers", src["customers"], lake,
                                 "1995-03")["status"] == "SKIPPED_EXISTS"
    out = J.bronze_to_silver(spark, lake, "1995-03", refresh_dims=True)
    raw = FX.raw_orders(spark, SF_SMALL).where(X.parsed_month("OrderDate") == "1995-03")
    direct = C.clean_orders(raw)
    a = direct.audit("orders").first()
    assert out["orders"] == {"valid": a["rows_valid"], "invalid": a["rows_invalid"]}
    silver = spark.read.parquet(lake.silver_orders).where("year = 1995 AND month = 3").drop("year", "month")
    assert sorted(map(tuple, silver.collect())) == sorted(map(tuple, direct.valid().collect()))
    assert out["customer"]["valid"] == C.clean_customers(FX.raw_customers(spark, SF_SMALL)).valid().count()
    # a rerun replaces the month's slice instead of adding to it
    J.bronze_to_silver(spark, lake, "1995-03")
    assert spark.read.parquet(lake.silver_orders).where("month = 3").count() == a["rows_valid"]
    quarantined = spark.read.parquet(lake.invalid("orders")).where("year = 1995 AND month = 3").drop("year", "month")
    assert sorted(map(str, quarantined.collect())) == sorted(map(str, direct.invalid().collect()))


def test_warehouse_and_monthly_fact_load(spark, lake_env):
    lake, _ = lake_env
    dups = J.build_dims(spark, lake, "1995-03", source="silver")
    assert dups["dim_customer"] == 0 and dups["dim_product"] == 0
    assert dups["dim_store"] > 0          # duplicate budget rows fan out valid stores (J1)
    assert spark.read.parquet(lake.warehouse("dim_customer")).count() == \
        spark.read.parquet(lake.silver_dim("customer")).count()
    direct = J.build_dims(spark, lake, "1995-03", source="bronze")     # the direct path also builds
    assert direct["dim_customer"] > 0     # no dedup on the direct path
    n_store = spark.read.parquet(lake.warehouse("dim_store")).count()
    J.build_dims(spark, lake, "1995-03", source="bronze", mode="append")   # INSERT INTO: rows again
    assert spark.read.parquet(lake.warehouse("dim_store")).count() == 2 * n_store
    J.build_dims(spark, lake, "1995-03", source="bronze")                  # SCD1 overwrite restores
    assert spark.read.parquet(lake.warehouse("dim_store")).count() == n_store
    rows = month_rows(spark, "1995-03")
    write_month_file(os.path.join(lake.landing_orders, "orders_1995-03.csv"), rows)
    write_month_file(os.path.join(lake.landing_orders, "orders_1995-06.csv"), [])
    r1 = J.load_month(spark, lake, key=os.path.join(lake.landing_orders, "orders_1995-03%2Ecsv"))
    assert (r1["status"], r1["rows_inserted"]) == ("SUCCEEDED", len(rows))
    r2 = J.load_month(spark, lake, key=os.path.join(lake.landing_orders, "orders_1995-03.csv"))
    assert (r2["status"], r2["rows_existing"]) == ("SKIPPED_EXISTS", len(rows))
    assert J.load_month(spark, lake, key=os.path.join(lake.landing_orders, "orders_1995-06.csv"))["status"] == \
        "SKIPPED_EMPTY_FILE"
    assert J.load_month(spark, lake, run_month="1995-09")["status"] == "ERROR"
    assert J.load_month(spark, lake, key=os.path.join(lake.landing_orders, "misc.csv"))["status"] == \
        "IGNORED_BAD_NAME"
    assert J.load_month(spark, lake)["status"] == "IGNORED_NO_INPUT"
    fact = spark.read.parquet(lake.warehouse("fact_sales"))
    assert fact.count() == len(rows) and {r[0] for r in fact.select("RunMonth").distinct().collect()} == {"1995-03"}
    # an ingested month without rows; a bronze slice, then the same month is there already
    assert J.load_month(spark, lake, run_month="1970-01", source="bronze")["status"] == "SKIPPED_EMPTY_FILE"
    n4 = spark.read.option("header", True).csv(lake.bronze_orders).where("year = 1995 AND month = 4").count()
    r4 = J.load_month(spark, lake, run_month="1995-04", source="bronze")
    assert (r4["status"], r4["rows_inserted"]) == ("SUCCEEDED", n4)
    assert J.load_month(spark, lake, run_month="1995-04", source="bronze")["status"] == "SKIPPED_EXISTS"
    fact = spark.read.parquet(lake.warehouse("fact_sales")).where("RunMonth = '1995-03'")
    views = J.register_views(spark, lake)
    assert spark.table("v_sales").count() >= len(rows)
    assert spark.table("v_calendar_month_loaded").first()["YearMonth"] == "1995-03"
    assert len(views) == 3


def test_next_month(spark, lake_env):
    lake, _ = lake_env
    assert J.next_month_job(spark, lake, "1995-01", "1995-12") == {
        "status": "INVOKED", "candidate": "1995-05", "last_succeeded": "1995-04"}
    r = J.next_month_job(spark, lake, "1995-01", "1995-04")
    assert r["status"] == "NO_ACTION" and r["candidate"] == "1995-05"
    empty = J.Lake(lake.root + "_none")
    assert J.next_month_job(spark, empty, "2011-05", "2014-05")["candidate"] == "2011-05"


def test_ingest_from_manifest_and_errors(spark, tmp_path):
    import json
    base = str(tmp_path)
    src = write_sources(spark, base)
    lake = J.Lake(os.path.join(base, "lake"))
    doc = {"run_defaults": {"allow_overwrite": False},
           "sources": [{"source_name": "orders", "type": "csv_github", "table": "orders",
                        "url_or_query": src["orders"], "date_field": "OrderDate",
                        "date_format": "MM-dd-yyyy", "pk": [], "fk": [], "dq_rules": []},
                       {"source_name": "customers", "type": "csv_github", "table": "customers",
                        "url_or_query": src["customers"], "pk": [], "fk": [], "dq_rules": []},
                       {"source_name": "stores", "type": "mysql", "table": "stores",
                        "url_or_query": "SELECT 1", "pk": [], "fk": [], "dq_rules": []}]}
    mpath = os.path.join(base, "sources.json")
    with open(mpath, "w") as fh:
        json.dump(doc, fh)
    out = J.ingest_from_manifest(spark, mpath, lake, ["1995-03"], refresh_dims=True)
    assert [d["table"] for d in out["dims"]] == ["customers"]
    assert out["orders"][0]["status"] == "SUCCEEDED" and out["orders"][0]["rows"] > 0
    # a manifest without a date format reads dash dates month first
    doc["sources"][0].pop("date_format")
    dashed = os.path.join(base, "dashed.csv")
    with open(dashed, "w") as fh:
        fh.write("SalesOrderID,OrderDate\n1,05-06-2011\n2,06-05-2011\n")
    doc["sources"][0]["url_or_query"] = dashed
    with open(mpath, "w") as fh:
        json.dump(doc, fh)
    out = J.ingest_from_manifest(spark, mpath, J.Lake(os.path.join(base, "lake2")), ["2011-05", "2011-06"])
    assert [(r["run_month"], r["rows"]) for r in out["orders"]] == [("2011-05", 1), ("2011-06", 1)]
    # no orders source -> error record, then the error is raised
    doc["sources"] = doc["sources"][1:]
    with open(mpath, "w") as fh:
        json.dump(doc, fh)
    with pytest.raises(RuntimeError):
        J.ingest_from_manifest(spark, mpath, lake, ["1995-04"])
    with pytest.raises(Exception):
        J.ingest_from_manifest(spark, os.path.join(base, "missing.json"), lake, ["1995-04"])
    codes = sorted(r["error_code"] for r in spark.read.parquet(lake.errors).collect())
    assert codes == ["LOAD_MANIFEST", "ORDERS_SRC_NOT_FOUND"]


ORDER_LINE = ("{id},1,{date},6/1/2011,6/2/2011,1,2,{sub},0.5,10,{total},3,2,5,0,10,4")
ORDER_HEAD = ("SalesOrderID,SalesOrderDetailID,OrderDate,DueDate,ShipDate,EmployeeID,CustomerID,SubTotal,TaxAmt,Freight,"
              "TotalDue,ProductID,OrderQty,UnitPrice,UnitPriceDiscount,LineTotal,StoreID")


def _delivery(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join([ORDER_HEAD, *lines]) + "\n")
    return path


def _line(i, date, total="20.5"):
    return ORDER_LINE.format(id=i, date=date, sub="10", total=total)


def test_corrected_rerun_leaves_nothing_behind(spark, tmp_path):
    """A slice that has no rows any more is emptied: quarantine, bronze, silver."""
    lake = J.Lake(str(tmp_path / "lake"))
    src = _delivery(tmp_path / "a.csv", [_line(1, "5/1/2011"), _line(2, "5/2/2011", "99"), _line(3, "6/1/2011")])
    J.ingest_orders(spark, str(src), lake, ["2011-05", "2011-06"])
    assert J.bronze_to_silver(spark, lake, "2011-05")["orders"] == {"valid": 1, "invalid": 1}
    src = _delivery(tmp_path / "b.csv", [_line(1, "5/1/2011"), _line(2, "5/2/2011")])
    res = J.ingest_orders(spark, str(src), lake, ["2011-05", "2011-06"], allow_overwrite=True)
    assert [(r["status"], r["rows"]) for r in res] == [("SUCCEEDED", 2), ("SUCCEEDED", 0)]
    assert spark.read.option("header", True).csv(lake.bronze_orders + "/year=2011/month=6").count() == 0
    assert J.bronze_to_silver(spark, lake, "2011-05")["orders"] == {"valid": 2, "invalid": 0}
    assert spark.read.parquet(lake.invalid("orders")).count() == 0
    assert J.bronze_to_silver(spark, lake, "2011-06")["orders"] == {"valid": 0, "invalid": 0}


def test_whole_chain_from_manifest_to_views(spark, tmp_path):
    """Ingest (CSV, JDBC, budget sheet) -> silver -> warehouse -> views, nothing landed by hand."""
    import json
    lake, src = J.Lake(str(tmp_path / "lake")), write_sources(spark, str(tmp_path))
    names = {v: k for k, v in J.MANIFEST_TABLES.items()}
    doc = {"run_defaults": {"allow_overwrite": False}, "sources": [
        {"type": "csv_github", "table": names[t], "url_or_query": src[t], "pk": [], "fk": [], "dq_rules": []}
        for t in src if t not in ("stores", "stores_budget")] + [
        {"type": "mysql", "table": "stores", "url_or_query":
         "SELECT BusinessEntityID AS StoreID, Name AS StoreName, SalesPersonID AS EmployeeID FROM Store;"},
        {"type": "excel", "table": "storesBudget"}]}
    (tmp_path / "sources.json").write_text(json.dumps(doc))
    url, props = "jdbc:derby:memory:thchain;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.createDataFrame([(i, f"Shop {i}", 1) for i in range(1, 11)],
                          "BUSINESSENTITYID int, NAME string, SALESPERSONID int").write.format("jdbc").option(
        "url", url).option("dbtable", "STORE").options(**props).mode("overwrite").save()
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "budget.csv").write_text("Report;\nTienda;Presupuesto\n" + "\n".join(f"{i};1.000,50" for i in range(1, 6)) + "\n")
    out = J.ingest_from_manifest(spark, str(tmp_path / "sources.json"), lake, ["1995-03"], refresh_dims=True,
                                 jdbc={"url": url, "properties": props}, budget={"inbox": str(inbox)})
    assert {d["table"]: d["rows"] for d in out["dims"]}["stores"] == 10
    assert {d["table"]: d["rows"] for d in out["dims"]}["stores_budget"] == 5
    control = {(r["source"], r["table"], r["status"]) for r in spark.read.parquet(lake.control).collect()}
    assert {("mysql", "stores", "SUCCEEDED"), ("excel", "stores_budget", "SUCCEEDED"), ("github", "orders", "SUCCEEDED")} <= control
    silver = J.bronze_to_silver(spark, lake, "1995-03", refresh_dims=True)
    assert silver["store"] == {"valid": 10, "invalid": 0}
    J.build_dims(spark, lake, "1995-03")
    loaded = J.load_month(spark, lake, run_month="1995-03")
    assert (loaded["status"], loaded["rows_inserted"]) == ("SUCCEEDED", silver["orders"]["valid"])
    J.register_views(spark, lake)
    assert spark.table("v_sales").count() == silver["orders"]["valid"]
    assert spark.table("v_dim_store").where("Budget = 1000.5").count() == 5
    # the bronze path: what ingest announced is what the stream loads
    from tallyhouse.streaming.file_arrival import start_fact_stream
    q = start_fact_stream(spark, lake.landing_orders, str(tmp_path / "fact2"), str(tmp_path / "status"),
                          str(tmp_path / "ckpt"), bronze_orders=lake.bronze_orders)
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.parquet(str(tmp_path / "fact2")).count() == out["orders"][0]["rows"]


def test_cli_dispatch(spark, tmp_path):
    from tallyhouse.cli import main
    lake = str(tmp_path / "lake")
    out = main(["next-month", "--lake", lake, "--start", "2011-05", "--end", "2014-05"], spark)
    assert out["candidate"] == "2011-05" and out["status"] == "INVOKED"
    assert main(["load-month", "--lake", lake], spark)["status"] == "IGNORED_NO_INPUT"
