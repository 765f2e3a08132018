"""Sources and sinks on small files in a scratch folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.sinks import writers as K
from tallyhouse.sources import bronze as B
from tallyhouse.sources import external as E
from tallyhouse.sources import manifest as MF


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_read_bronze_quotes_and_short_rows(spark, scratch):
    p = os.path.join(scratch, "stores.csv")
    _write(p, 'StoreID,StoreName,EmployeeID\n1,"A ""quoted"", name",7\n2,,\n3,short\n')
    rows = [tuple(r) for r in B.read_bronze(spark, "stores", p).drop(B.RID).collect()]
    assert rows == [("1", 'A "quoted", name', "7"), ("2", None, None), ("3", "short", None)]
    typed = B.read_typed(spark, "stores", p).collect()
    assert [r["StoreID"] for r in typed] == [1, 2, 3] and typed[0]["EmployeeID"] == 7
    bad = B.read_typed(spark, "stores", p, corrupt_col="_corrupt").collect()
    assert [r["_corrupt"] for r in bad] == [None, None, "3,short"]


def test_read_month_prunes_partitions(spark, scratch):
    base = os.path.join(scratch, "orders")
    for y, m, n in [(2011, 5, 3), (2011, 6, 2), (2012, 5, 4)]:
        rows = "\n".join(",".join([str(i)] * 17) for i in range(n))
        _write(os.path.join(base, f"year={y}", f"month={m}", "part.csv"),
               ",".join(B.RAW_COLUMNS["orders"]) + "\n" + rows + "\n")
    df = B.read_month(spark, "orders", base, "2011-05")
    assert df.count() == 3
    # only that month's folder is named to the reader
    assert len(df.inputFiles()) == 1 and "year=2011/month=5" in df.inputFiles()[0]
    assert {tuple(r) for r in df.select("year", "month").collect()} == {(2011, 5)}
    assert B.read_months(spark, "orders", base, ["2011-06", "2012-05"], row_id=False).count() == 6


def test_file_slice_and_rows_per_file(spark, scratch):
    d = os.path.join(scratch, "landing")
    _write(os.path.join(d, "a.csv"), "StoreID,StoreName,EmployeeID\n1,x,1\n2,y,2\n")
    _write(os.path.join(d, "b.csv"), "StoreID,StoreName,EmployeeID\n3,z,3\n")
    df = B.read_bronze(spark, "stores", d, row_id=False)
    assert [r[0] for r in B.read_file_slice(df, os.path.join(d, "b.csv")).select("StoreID").collect()] == ["3"]
    counts = {os.path.basename(r["file_path"]): r["n"] for r in B.rows_per_file(df).collect()}
    assert counts == {"a.csv": 2, "b.csv": 1}


def test_land_csv_multiline(spark, scratch):
    src = os.path.join(scratch, "src.csv")
    _write(src, 'CustomerID,FirstName,LastName,FullName\n1,"Ann\nMarie",Lee,"Ann Lee"\n2,Bo,Ek,Bo Ek\n')
    n = B.land_csv(spark, src, os.path.join(scratch, "bronze"), multiline=True)
    assert n == 2
    back = B.read_bronze(spark, "customers", os.path.join(scratch, "bronze"), row_id=False,
                         multiline=True)
    assert back.count() == 2
    assert back.where("CustomerID = '1'").first()["FirstName"] == "Ann\nMarie"
    # line records (the default) split a quoted line break, like the reference's table
    assert B.read_bronze(spark, "customers", os.path.join(scratch, "bronze"), row_id=False).count() == 3


def test_write_once_and_slices(spark, scratch):
    df = spark.range(5).select(F.col("id").cast("string").alias("v"))
    t = os.path.join(scratch, "once")
    assert K.write_once(df, t, header=True) == ("SUCCEEDED", 5)
    assert K.write_once(df, t, header=True) == ("SKIPPED_EXISTS", 0)
    assert K.write_once(df.limit(2), t, True, header=True) == ("SUCCEEDED", 2)
    assert K.write_once(df.limit(0), os.path.join(scratch, "none"), header=True) == ("SUCCEEDED", 0)
    # a folder left by a failed job (no commit marker) is rewritten, not skipped
    half = os.path.join(scratch, "half")
    _write(os.path.join(half, "part-0.csv"), "v\n1\n")
    assert not K.is_committed(spark, half)
    assert K.write_once(df, half, header=True) == ("SUCCEEDED", 5)
    assert K.is_committed(spark, half)
    p = os.path.join(scratch, "fact")
    a = spark.createDataFrame([("2011-05", 1), ("2011-06", 2)], "RunMonth string, x int")
    K.overwrite_slice(a, p, ["RunMonth"])
    K.overwrite_slice(spark.createDataFrame([("2011-06", 9)], "RunMonth string, x int"), p, ["RunMonth"])
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("RunMonth", "x").collect())
    assert got == [("2011-05", 1), ("2011-06", 9)]
    # a slice that is asked for and has no rows any more is emptied
    assert K.overwrite_slice(spark.createDataFrame([("2011-06", 7), ("2011-06", 8)], "RunMonth string, x int"), p,
                             ["RunMonth"], [{"RunMonth": "2011-05"}, {"RunMonth": "2011-06"}]) == [0, 2]
    got = sorted(tuple(r) for r in spark.read.parquet(p).select("RunMonth", "x").collect())
    assert got == [("2011-06", 7), ("2011-06", 8)]
    K.overwrite_slice(a, p, ["RunMonth"])
    K.append_table(spark.createDataFrame([("2011-05", 3)], "RunMonth string, x int"), p, ["RunMonth"])
    assert spark.read.parquet(p).count() == 3


def test_control_and_error_logs(spark, scratch):
    c = os.path.join(scratch, "control")
    K.log_control(spark, c, [{"run_id": "r1#orders", "run_month": "2011-05", "source": "github",
                              "table": "orders", "status": "SUCCEEDED", "records_out": 10}])
    K.log_control(spark, c, [{"run_id": "r2#orders", "run_month": "2011-06", "source": "github",
                              "table": "orders", "status": "SKIPPED_EXISTS", "records_out": 0,
                              "note": "exists"}])
    assert spark.read.parquet(c).count() == 2
    assert spark.read.parquet(c).where("started_at IS NULL OR ended_at IS NULL").count() == 0
    e = os.path.join(scratch, "errors")
    K.log_error(spark, e, "r1", "github", "_manifest", "ingest", "LOAD_MANIFEST", "boom" * 5000)
    r = spark.read.parquet(e).first()
    assert r["error_code"] == "LOAD_MANIFEST" and len(r["message"]) == 20_000 and r["ts"] > 1_500_000_000


def test_register_table_and_partition(spark, scratch):
    p = os.path.join(scratch, "tbl")
    K.overwrite_slice(spark.createDataFrame([("2011-05", 1)], "RunMonth string, x int"), p, ["RunMonth"])
    K.register_table(spark, "fact_test", p, "x int, RunMonth string", partition_cols=["RunMonth"])
    assert spark.table("fact_test").count() == 1
    K.overwrite_slice(spark.createDataFrame([("2011-06", 2)], "RunMonth string, x int"), p, ["RunMonth"])
    K.add_partition(spark, "fact_test", {"RunMonth": "2011-06"}, os.path.join(p, "RunMonth=2011-06"))
    assert spark.table("fact_test").count() == 2
    c = os.path.join(scratch, "stores_csv")
    _write(os.path.join(c, "a.csv"), "StoreID,StoreName\n1,x\n2,y\n")
    K.register_table(spark, "stores_test", c, "StoreID int, StoreName string", "csv", options={"header": "true"})
    assert [tuple(r) for r in spark.table("stores_test").collect()] == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("hdr", ["StoreID;Budget", "Tienda;Presupuesto", "store_id;importe", "id;monto"])
def test_budget_sheet(spark, scratch, hdr):
    p = os.path.join(scratch, "budget.csv")
    _write(p, ";\nReport;\n" + hdr + "\n292;$60.749.820.000\n293;60.749.820,50\n294;\n;5\n295; 1 234 \n;\n")
    got = sorted(tuple(r) for r in E.read_budget_sheet(spark, p).collect())
    assert got == [("292", "60749820000"), ("293", "60749820.50"), ("295", "1234")]


def test_budget_sheet_missing_columns(spark, scratch):
    p = os.path.join(scratch, "bad.csv")
    _write(p, "a;b\n1;2\n")
    with pytest.raises(ValueError):
        E.read_budget_sheet(spark, p)


def test_manifest(spark, scratch):
    doc = {"run_defaults": {"allow_overwrite": False, "months_partitioning": "year-month"},
           "sources": [
               {"source_name": "orders_csv", "type": "csv_github", "table": "orders",
                "date_field": "OrderDate", "date_format": "MM-dd-yyyy",
                "pk": ["SalesOrderID", "SalesOrderDetailID"], "fk": ["CustomerID"],
                "dq_rules": ["not_null:SalesOrderID"]},
               {"source_name": "stores_db", "type": "mysql", "table": "stores", "pk": ["StoreID"],
                "fk": [], "dq_rules": []}]}
    p = os.path.join(scratch, "sources.json")
    _write(p, json.dumps(doc, indent=2))
    sources, defaults = MF.load_manifest(spark, p)
    assert sources.count() == 2 and defaults.first()["months_partitioning"] == "year-month"
    assert MF.select_sources(sources, type_="csv_github").count() == 1
    assert MF.first_source(sources, "orders")["date_format"] == "MM-dd-yyyy"
    assert MF.first_source(sources, "nope") is None
    assert MF.rules_from_sources(sources)[0] == ("orders", ["SalesOrderID", "SalesOrderDetailID"],
                                                 ["CustomerID"], ["not_null:SalesOrderID"])


def test_pick_inbox_file(spark, scratch):
    d = os.path.join(scratch, "inbox")
    for n in ["b.XLSX", "a.xlsx", "c.txt"]:
        _write(os.path.join(d, n), "x")
    assert E.pick_inbox_file(spark, d).endswith("/a.xlsx")
    with pytest.raises(FileNotFoundError):
        E.pick_inbox_file(spark, d, ".parquet")


def test_jdbc_store_query(spark):
    url = "jdbc:derby:memory:thstores;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.createDataFrame([(1, "Bike Shop", 275), (2, "Wheels", None)],
                                "BUSINESSENTITYID int, NAME string, SALESPERSONID int")
    src.write.format("jdbc").option("url", url).option("dbtable", "STORE").options(**props).mode(
        "overwrite").save()
    df = E.read_jdbc_query(spark, url, properties=props)
    assert df.columns == ["StoreID", "StoreName", "EmployeeID"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Bike Shop", 275), (2, "Wheels", None)]
    par = E.read_jdbc_query(spark, url, properties=props, partition_column="StoreID", lower=1,
                            upper=3, num_partitions=2)
    assert par.rdd.getNumPartitions() == 2 and par.count() == 2


def test_read_warehouse_schema(spark, scratch):
    from tallyhouse.operators.warehouse import read_warehouse, to_warehouse
    p = os.path.join(scratch, "dim_store")
    from decimal import Decimal
    df = spark.createDataFrame([(1, "A", 2, Decimal("10.00"))], "StoreKey int, StoreName string, EmployeeID int, "
                               "Budget decimal(18,2)")
    to_warehouse(df, "dim_store").write.parquet(p)
    df = read_warehouse(spark, p, "dim_store")
    assert df.schema.simpleString() == "struct<StoreKey:int,StoreName:string,EmployeeID:int,Budget:double>"
    assert df.first()["Budget"] == 10.0


def test_scalar_int_default(spark):
    from tallyhouse.plans.loads import scalar_int
    assert scalar_int(spark.range(0).select("id")) == 0
    assert scalar_int(spark.sql("select cast(null as int)"), 5) == 5
    assert scalar_int(spark.sql("select 'x'"), 7) == 7
    assert scalar_int(spark.sql("select '42.0'")) == 42
