"""Measures and views on tiny hand-made facts: every branch of each rule."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.operators import measures as M
from tallyhouse.operators import views as V

FACT_SCHEMA = ("SalesOrderKey int, SalesOrderDetailKey int, OrderDate date, RunMonth string, "
               "EmployeeKey int, CustomerKey int, ProductKey int, StoreKey int, OrderQty int, "
               "UnitPrice double, UnitPriceDiscount double, SubTotal double, TaxAmt double, "
               "Freight double, TotalDue double, LineTotal double")


def fact(spark, rows):
    full = [(i, 1, dt.date(2011, 5, 1), ym, emp, 1, prod, store, qty, 1.0, 0.0, 1.0, 0.0, 0.0, due, line)
            for i, (ym, emp, prod, store, qty, due, line) in enumerate(rows)]
    return spark.createDataFrame(full, FACT_SCHEMA)


def test_compliance_bands(spark):
    f = fact(spark, [("2011-05", 1, 1, s, 1, due, due) for s, due in
                     [(1, 600.0), (2, 5.0), (3, 50.0), (4, 10.0), (5, 10.0)]])
    st = spark.createDataFrame(
        [(1, "a", Decimal("100.00")), (2, "b", Decimal("100.00")), (3, "c", Decimal("100.00")),
         (4, "d", Decimal("0.00"))], "StoreKey int, StoreName string, Budget decimal(18,2)")
    got = {r["StoreKey"]: r["band"] for r in M.store_compliance_bands(f, st).collect()}
    assert got == {1: "OVER_500", 2: "UNDER_10", 3: "WITHIN", 4: "NO_BUDGET", 5: "NO_BUDGET"}
    bc = M.budget_compliance(f, st).first()
    assert bc["total_sales"] == Decimal("675.0000") and bc["total_budget"] == Decimal("300.00")
    assert abs(bc["compliance"] - 2.25) < 1e-12


def test_cumulative_sales_densifies_months(spark):
    f = fact(spark, [("2011-05", 1, 1, 1, 1, 10.0, 10.0), ("2011-07", 1, 1, 1, 1, 5.0, 5.0),
                     ("2011-06", 2, 1, 1, 1, 7.0, 7.0)])
    em = spark.createDataFrame([(1, "US"), (2, "FR")], "EmployeeKey int, Country string")
    got = {(r["Country"], r["YearMonth"]): (float(r["sales"]), float(r["cumulative_sales"]))
           for r in M.cumulative_sales(f, em).collect()}
    assert got == {("US", "2011-05"): (10.0, 10.0), ("US", "2011-06"): (0.0, 10.0),
                   ("US", "2011-07"): (5.0, 15.0), ("FR", "2011-05"): (0.0, 0.0),
                   ("FR", "2011-06"): (7.0, 7.0), ("FR", "2011-07"): (0.0, 7.0)}


def test_margin_units_header_and_calendar(spark):
    f = fact(spark, [("2011-05", 1, 1, 1, 2, 30.0, 20.0), ("2011-05", 1, 2, 1, 1, 30.0, 10.0),
                     ("2011-12", 1, 9, 2, 3, 4.0, 4.0)])
    f = f.withColumn("SalesOrderKey", F.when(F.col("RunMonth") == "2011-05", 1).otherwise(2))
    pr = spark.createDataFrame([(1, 5.0), (2, 8.0)], "ProductKey int, StandardCost double")
    gm = {r["RunMonth"]: r["gross_margin"] for r in M.gross_margin(f, pr).collect()}
    assert gm == {"2011-05": Decimal("12.0000"), "2011-12": None}   # unknown cost left out
    us = {r["RunMonth"]: r["units_sold"] for r in M.units_sold(f).collect()}
    assert us == {"2011-05": 3, "2011-12": 3}
    line = {r["RunMonth"]: r["total_sales"] for r in M.total_sales(f).collect()}
    head = {r["RunMonth"]: r["total_sales_header"] for r in M.total_sales_header(f).collect()}
    assert line["2011-05"] == Decimal("60.0000") and head["2011-05"] == Decimal("30.0000")
    cal = {r["YearMonth"]: (r["MonthDate"], r["Year"], r["Month"], r["MonthShort"], r["Quarter"])
           for r in V.v_calendar_month_loaded(f).collect()}
    assert cal == {"2011-05": (dt.date(2011, 5, 1), 2011, 5, "May", 2),
                   "2011-12": (dt.date(2011, 12, 1), 2011, 12, "Dec", 4)}
    div = {r["StoreKey"]: (r["n_products"], r["n_lines"])
           for r in M.store_diversity(f, spark.createDataFrame([(1, "s")], "StoreKey int, StoreName string")).collect()}
    assert div == {1: (2, 2), 2: (1, 1)}


def test_land_csv_replaces_bad_bytes(spark, scratch):
    from tallyhouse.sources import bronze as B
    src = os.path.join(scratch, "bad.csv")
    with open(src, "wb") as fh:
        fh.write(b"StoreID,StoreName,EmployeeID\n1,Caf\xe9,7\n")
    assert B.land_csv(spark, src, os.path.join(scratch, "out")) == 1
    name = B.read_bronze(spark, "stores", os.path.join(scratch, "out"), row_id=False).first()["StoreName"]
    assert name.startswith("Caf") and "�" in name


def test_store_diversity_from_words_that_spill(spark):
    """The months' product sets unite to the distinct counts, in words of a few
    bytes each that an aggregate with fixed-width buffers makes."""
    from tallyhouse.operators import rollups as R
    rows = [("2011-05", 1, p, s, 1, 1.0, 1.0) for s, keys in
            {1: [1, 63, 64, 65, 40000, 2147483647], 2: [-1, -64, -65, 0, 7], 3: [None], None: [5, 6]}.items() for p in keys]
    rows += [("2011-06", *r[1:]) for r in rows if r[2] in (64, -1, 0, 5)] + [("2011-06", 1, 8, 2, 1, 1.0, 1.0)]
    f = fact(spark, rows)
    st = spark.createDataFrame([(1, "s"), (3, "t")], "StoreKey int, StoreName string")
    assert sorted(map(str, R.store_diversity(R.partials(f), st).collect())) == \
        sorted(map(str, M.store_diversity(f, st).collect()))
    assert {r["StoreKey"]: r["n_products"] for r in R.store_diversity(R.partials(f), st).collect()} == \
        {1: 6, 2: 6, 3: 0, None: 2}
    plan = R.store_diversity(R.partials(f), st)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
