"""Additive partials of the fact per RunMonth, and the measures M1-M8 from them.

A month's partials are a function of that month's rows alone, so a load, a rerun
or a backfill replaces the slices of its months and touches no others; measures
then read the partials, not the fact.

* ``employee_product``: per month, employee and product, the sums behind M1,
  M3-M5, M7 and the sales by month and country;
* ``store``: per month and store, the sums behind M2, M6 and M8;
* ``month``: M1 counted once per order (an order's lines are in one month);
* ``store_product_words``: per month and store, which products were sold, a bit
  per product in words of 64 neighbouring keys.  Distinct counts do not add up,
  but bits unite.  A word is written only where a product was sold, so there are
  no more words than the month's distinct (store, product) pairs, and their
  aggregates spill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import measures as M

TABLES = ["employee_product", "store", "month", "store_product_words"]
SCHEMAS = {
    "employee_product": "EmployeeKey int, ProductKey int, _lines decimal(38,4), _qty decimal(20,0), "
                        "_due decimal(38,4), _units bigint, _n bigint, RunMonth string",
    "store": "StoreKey int, due decimal(38,4), n_lines bigint, RunMonth string",
    "month": "total_sales_header decimal(38,4), RunMonth string",
    "store_product_words": "StoreKey int, word bigint, products bigint, RunMonth string",
}


def employee_product(fact: DataFrame) -> DataFrame:
    return M.margin_parts(fact, ["RunMonth", "EmployeeKey"])


def store(fact: DataFrame) -> DataFrame:
    return fact.groupBy("RunMonth", "StoreKey").agg(
        F.sum(M.money("TotalDue")).cast(M.MONEY).alias("due"), F.count(F.lit(1)).alias("n_lines"))


def month(fact: DataFrame) -> DataFrame:
    return M.total_sales_header(fact)


def store_product_words(fact: DataFrame) -> DataFrame:
    return fact.where("ProductKey IS NOT NULL").groupBy(
        "RunMonth", "StoreKey", F.shiftright(F.col("ProductKey").cast("bigint"), 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(ProductKey & 63 AS int))")).alias("products"))


def partials(fact: DataFrame) -> dict[str, DataFrame]:
    """Every partial table of the given fact rows."""
    return {"employee_product": employee_product(fact), "store": store(fact),
            "month": month(fact), "store_product_words": store_product_words(fact)}


# ------------------------------------------------------ measures from partials
def total_sales(p: dict) -> DataFrame:
    return p["employee_product"].groupBy("RunMonth").agg(F.sum("_due").cast(M.MONEY).alias("total_sales"))


def total_sales_header(p: dict) -> DataFrame:
    return p["month"]


def units_sold(p: dict) -> DataFrame:
    return p["employee_product"].groupBy("RunMonth").agg(F.sum("_units").cast("bigint").alias("units_sold"))


def gross_margin(p: dict, dim_product: DataFrame) -> DataFrame:
    return M.gross_margin_of(M.sum_parts(p["employee_product"], ["RunMonth"]), dim_product)


def margin_by_country(p: dict, dim_employee: DataFrame, dim_product: DataFrame) -> DataFrame:
    return M.margin_by_country_of(M.sum_parts(p["employee_product"], ["EmployeeKey"]), dim_employee, dim_product)


def sales_by_month_country(p: dict, dim_employee: DataFrame) -> DataFrame:
    per = p["employee_product"].groupBy("RunMonth", "EmployeeKey").agg(
        F.sum("_due").cast(M.MONEY).alias("_due"), F.sum("_units").alias("_qty"), F.sum("_n").alias("_n"))
    return M.sales_by_month_country_of(per, dim_employee)


def cumulative_sales(p: dict, dim_employee: DataFrame) -> DataFrame:
    return M.cumulative_of(sales_by_month_country(p, dim_employee))


def budget_compliance(p: dict, dim_store: DataFrame) -> DataFrame:
    return M.budget_compliance_of(p["store"].agg(F.sum("due").cast(M.MONEY).alias("total_sales")), dim_store)


def store_compliance_bands(p: dict, dim_store: DataFrame) -> DataFrame:
    return M.store_compliance_bands_of(
        p["store"].groupBy("StoreKey").agg(F.sum("due").cast(M.MONEY).alias("total_sales")), dim_store)


def store_diversity(p: dict, dim_store: DataFrame) -> DataFrame:
    """M8: the months' words of a store united, then their bits counted."""
    united = p["store_product_words"].groupBy("StoreKey", "word").agg(F.bit_or("products").alias("products"))
    distinct = united.groupBy("StoreKey").agg(F.sum(F.bit_count("products").cast("bigint")).alias("n_products"))
    sales = p["store"].groupBy("StoreKey").agg(F.sum("due").cast(M.MONEY).alias("total_sales"),
                                               F.sum("n_lines").alias("n_lines"))
    d = distinct.withColumnRenamed("StoreKey", "_dk")
    per = sales.join(d, F.col("StoreKey").eqNullSafe(F.col("_dk")), "left").withColumn(
        "n_products", F.coalesce("n_products", F.lit(0).cast("bigint")))
    st = dim_store.select(F.col("StoreKey").alias("_sk"), "StoreName")
    return per.join(st, per.StoreKey == st._sk, "left").select(
        "StoreKey", "StoreName", "n_products", "total_sales", "n_lines")
