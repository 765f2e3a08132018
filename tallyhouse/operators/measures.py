"""BI measures over the fact and validated dimensions.

Money is summed as DECIMAL so totals are exact and engine-independent.  Every
measure aggregates the fact first (partial aggregation collapses hot keys
map-side) and joins dimensions to the small aggregated side where possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X

MONEY = "decimal(38,4)"


def money(c) -> Column:
    """Fact amounts carry at most 4 decimals; DECIMAL(18,4) holds them exactly."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")


def _sum_money(c: Column, name: str) -> Column:
    return F.sum(c).cast(MONEY).alias(name)


def total_sales(fact: DataFrame) -> DataFrame:
    """M1 as written: SUM(TotalDue) over order lines, per month."""
    return fact.groupBy("RunMonth").agg(_sum_money(money("TotalDue"), "total_sales"))


def total_sales_header(fact: DataFrame) -> DataFrame:
    """M1 corrected: one TotalDue (max) per order, then summed per month."""
    per_order = fact.groupBy("RunMonth", "SalesOrderKey").agg(F.max(money("TotalDue")).alias("h"))
    return per_order.groupBy("RunMonth").agg(_sum_money(F.col("h"), "total_sales_header"))


def units_sold(fact: DataFrame) -> DataFrame:
    """M4: SUM(OrderQty) per month."""
    return fact.groupBy("RunMonth").agg(F.sum("OrderQty").cast("bigint").alias("units_sold"))


def margin_parts(fact: DataFrame, by: list[str]) -> DataFrame:
    """Per (``by``, product): what sales, units and gross margin need, before any
    join.  Lines without an amount or a quantity have no margin; ``_due``,
    ``_units`` and ``_n`` count all.  The sums add up over any coarser groups."""
    both = F.col("LineTotal").isNotNull() & F.col("OrderQty").isNotNull()
    return fact.groupBy(*by, "ProductKey").agg(
        F.sum(F.when(both, money("LineTotal"))).cast(MONEY).alias("_lines"),
        F.sum(F.when(both, F.col("OrderQty"))).cast("decimal(20,0)").alias("_qty"),
        F.sum(money("TotalDue")).cast(MONEY).alias("_due"),
        F.sum("OrderQty").cast("bigint").alias("_units"), F.count(F.lit(1)).alias("_n"))


def sum_parts(parts: DataFrame, by: list[str]) -> DataFrame:
    """``margin_parts`` of coarser groups."""
    return parts.groupBy(*by, "ProductKey").agg(
        F.sum("_lines").cast(MONEY).alias("_lines"), F.sum("_qty").cast("decimal(20,0)").alias("_qty"),
        F.sum("_due").cast(MONEY).alias("_due"))


def _with_margin(parts: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The product's cost joined to the aggregated lines (one row per product
    key and group, times the product's dimension rows)."""
    p = dim_product.select(F.col("ProductKey").alias("_pk"),
                           F.col("StandardCost").cast("decimal(18,2)").alias("_cost"))
    return parts.join(p, parts.ProductKey == p._pk, "left").withColumn(
        "_margin", F.col("_lines") - (F.col("_qty") * F.col("_cost")).cast(MONEY))


def gross_margin(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M5: SUM(LineTotal - OrderQty * StandardCost) per month; lines without a
    known product cost are left out of the sum."""
    return gross_margin_of(margin_parts(fact, ["RunMonth"]), dim_product)


def gross_margin_of(parts: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _with_margin(parts, dim_product).groupBy("RunMonth").agg(_sum_money(F.col("_margin"), "gross_margin"))


def budget_compliance(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """M2: total sales / total budget (SUM of the store dimension's Budget)."""
    return budget_compliance_of(fact.agg(_sum_money(money("TotalDue"), "total_sales")), dim_store)


def budget_compliance_of(total: DataFrame, dim_store: DataFrame) -> DataFrame:
    # the budget total is a scalar subquery: one value, evaluated once
    budget = dim_store.agg(F.sum(F.col("Budget").cast("decimal(18,2)")).cast("decimal(38,2)")).scalar()
    j = total.withColumn("total_budget", budget)
    return j.select("total_sales", "total_budget",
                    X.safe_ratio(F.col("total_sales").cast("double"),
                                 F.col("total_budget").cast("double")).alias("compliance"))


def store_compliance_bands(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """M6: per-store sales / budget, banded over +500 % and under 10 %."""
    return store_compliance_bands_of(
        fact.groupBy("StoreKey").agg(_sum_money(money("TotalDue"), "total_sales")), dim_store)


def store_compliance_bands_of(sales: DataFrame, dim_store: DataFrame) -> DataFrame:
    st = dim_store.select(F.col("StoreKey").alias("_sk"), "StoreName",
                          F.col("Budget").cast("decimal(18,2)").alias("Budget"))
    j = sales.join(st, sales.StoreKey == st._sk, "left")
    ratio = X.safe_ratio(F.col("total_sales").cast("double"), F.col("Budget").cast("double"))
    band = (F.when(ratio.isNull(), "NO_BUDGET").when(ratio > 5.0, "OVER_500")
            .when(ratio < 0.1, "UNDER_10").otherwise("WITHIN"))
    return j.select("StoreKey", "StoreName", "total_sales", "Budget",
                    ratio.alias("compliance"), band.alias("band"))


def _with_country(rows: DataFrame, dim_employee: DataFrame) -> DataFrame:
    e = dim_employee.select(F.col("EmployeeKey").alias("_ek"), "Country")
    return rows.join(e, rows.EmployeeKey == e._ek, "left")


def margin_by_country(fact: DataFrame, dim_employee: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M7: sales and gross margin per employee Country, both dimensions joined
    to lines already summed per (employee, product)."""
    return margin_by_country_of(margin_parts(fact, ["EmployeeKey"]), dim_employee, dim_product)


def margin_by_country_of(parts: DataFrame, dim_employee: DataFrame, dim_product: DataFrame) -> DataFrame:
    parts = _with_margin(parts, dim_product)
    per = parts.groupBy("EmployeeKey").agg(F.sum("_due").cast(MONEY).alias("_due"),
                                           F.sum("_margin").cast(MONEY).alias("_margin"))
    return _with_country(per, dim_employee).groupBy("Country").agg(
        _sum_money(F.col("_due"), "total_sales"), _sum_money(F.col("_margin"), "gross_margin"))


def sales_by_month_country(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Flagship: the sales view sliced by month and employee country; the fact
    is summed per (month, employee) before the country is joined."""
    per = fact.groupBy("RunMonth", "EmployeeKey").agg(
        F.sum(money("TotalDue")).cast(MONEY).alias("_due"), F.sum("OrderQty").alias("_qty"),
        F.count(F.lit(1)).alias("_n"))
    return sales_by_month_country_of(per, dim_employee)


def sales_by_month_country_of(per: DataFrame, dim_employee: DataFrame) -> DataFrame:
    return _with_country(per, dim_employee).groupBy("RunMonth", "Country").agg(
        _sum_money(F.col("_due"), "total_sales"),
        F.sum("_qty").cast("bigint").alias("units"),
        F.sum("_n").cast("bigint").alias("lines"))


def cumulative_sales(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Running total per Country over a dense month calendar.

    The fact is scanned once, into the (Country, month) totals.  From these
    alone come the range of months and the calendar: a country's gaps between
    one month and its next (and out to both ends of the range) are filled with
    ``sequence``.  The windows run over countries x months only.
    """
    return cumulative_of(sales_by_month_country(fact, dim_employee))


def cumulative_of(by_month_country: DataFrame) -> DataFrame:
    monthly = by_month_country.select(
        "Country", F.col("RunMonth").alias("YearMonth"), "total_sales")
    month = X.month_start("YearMonth")
    whole = Window.partitionBy()                    # as many rows as countries x months
    own = Window.partitionBy("Country").orderBy("YearMonth")
    spans = monthly.select(
        "*", F.min(month).over(whole).alias("_lo"), F.max(month).over(whole).alias("_hi"),
        F.row_number().over(own).alias("_k"), F.lead(month).over(own).alias("_next"))
    # the first row of a country also covers the months before it
    begin = F.when(F.col("_k") == 1, F.col("_lo")).otherwise(month)
    end = F.coalesce(F.add_months("_next", -1), F.col("_hi"))
    dense = spans.select("Country", month.alias("_m"), "total_sales", F.explode(
        F.sequence(begin, end, F.expr("INTERVAL 1 MONTH"))).alias("m")).select(
        "Country", F.date_format("m", "yyyy-MM").alias("YearMonth"),
        F.when(F.col("m") == F.col("_m"), F.coalesce("total_sales", F.lit(0).cast(MONEY)))
        .otherwise(F.lit(0).cast(MONEY)).alias("sales"))
    w = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.withColumn("cumulative_sales", F.sum("sales").over(w).cast(MONEY))


def store_diversity(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """M8: distinct products per store against the store's sales."""
    per = fact.groupBy("StoreKey").agg(
        F.countDistinct("ProductKey").alias("n_products"),
        _sum_money(money("TotalDue"), "total_sales"),
        F.count(F.lit(1)).alias("n_lines"))
    st = dim_store.select(F.col("StoreKey").alias("_sk"), "StoreName")
    return per.join(st, per.StoreKey == st._sk, "left").select(
        "StoreKey", "StoreName", "n_products", "total_sales", "n_lines")
