"""BI views as DataFrame functions.

View, joins and the consumer's aggregate form one Catalyst plan, so column
pruning reaches the parquet scans.  The dimension joins are left outer joins
without fixed broadcast hints: dimensions grow with the business, so Catalyst/AQE
broadcast them only when their measured size is under the threshold, and a
skewed fact key (NULL or hot) is split by AQE's skew-join handling.  A dimension
that is itself a query is estimated too large, and AQE learns its size only when
the fact has been shuffled already: such a one can be counted first
(``broadcast_if_small``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X

V_SALES_COLS = ["SalesOrderKey", "SalesOrderDetailKey", "OrderDate", "RunMonth", "CustomerName",
                "EmployeeName", "JobTitle", "Territory", "Country", "StoreKey", "ProductKey",
                "ProductName", "ModelName", "SubCategoryName", "CategoryName", "OrderQty",
                "UnitPrice", "UnitPriceDiscount", "SubTotal", "TaxAmt", "Freight", "TotalDue",
                "LineTotal"]


SMALL_VALUES = 1_000_000     # rows times columns, some tens of MB


def broadcast_if_small(dim: DataFrame) -> DataFrame:
    """``dim`` marked for broadcast if counting finds at most SMALL_VALUES values
    in it, else as it is (for a shuffle, or what Catalyst estimates)."""
    most = SMALL_VALUES // len(dim.columns)
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


def v_sales(fact: DataFrame, dim_customer: DataFrame, dim_employee: DataFrame,
            dim_store: DataFrame, dim_product: DataFrame,
            store_keys_unique: bool = False, counted: bool = False) -> DataFrame:
    """Fact LEFT JOIN customer, employee, store, product.

    The store join adds no column but is kept: duplicate store keys fan out
    lines, exactly as the view does.  When the caller has proven StoreKey
    unique (``store_keys_unique``) the join cannot change the result and is
    left out.

    Every join's key is the fact's own, so their order is free: customers and
    products, which may need the fact shuffled, come first, the narrower one
    before the wider, so that no shuffle carries another dimension's texts
    without need.  ``counted``: employees and store keys are counted now, and
    broadcast where they are few.
    """
    c = dim_customer.select(F.col("CustomerKey").alias("_ck"), F.col("FullName").alias("CustomerName"))
    e = dim_employee.select(F.col("EmployeeKey").alias("_ek"), F.col("FullName").alias("EmployeeName"),
                            "JobTitle", "Territory", "Country")
    s = dim_store.select(F.col("StoreKey").alias("_sk"))
    p = dim_product.select(F.col("ProductKey").alias("_pk"), "ProductName", "ModelName",
                           "SubCategoryName", "CategoryName")
    if counted:
        e, s = broadcast_if_small(e), s if store_keys_unique else broadcast_if_small(s)
    j = (fact.join(c, fact.CustomerKey == c._ck, "left")
         .join(p, fact.ProductKey == p._pk, "left")
         .join(e, fact.EmployeeKey == e._ek, "left"))
    if not store_keys_unique:
        j = j.join(s, fact.StoreKey == s._sk, "left")
    return j.select(*[F.col("OrderDate").cast("date").alias("OrderDate") if c_ == "OrderDate"
                      else F.col(c_) for c_ in V_SALES_COLS])


def v_dim_store(dim_store: DataFrame) -> DataFrame:
    return dim_store.select("StoreKey", "StoreName", "Budget")


def v_calendar_month_loaded(fact: DataFrame) -> DataFrame:
    """V3: one row per loaded month.  The six columns are functions of RunMonth,
    so the distinct runs on RunMonth alone (a tiny partial aggregate)."""
    m = fact.select("RunMonth").distinct()
    ym = F.col("RunMonth")
    return m.select(
        X.month_start(ym).alias("MonthDate"),
        ym.alias("YearMonth"),
        F.substring(ym, 1, 4).cast("int").alias("Year"),
        F.substring(ym, 6, 2).cast("int").alias("Month"),
        F.date_format(X.month_start(ym), "MMM").alias("MonthShort"),
        F.quarter(X.month_start(ym)).cast("int").alias("Quarter"),
    )


def of_months(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact rows of the calendar's months.  The calendar has a row per loaded
    month, so it is broadcast, and its filters prune the fact's RunMonth
    partitions at run time."""
    months = calendar.select(F.col("YearMonth").alias("_ym")).distinct()
    return fact.join(F.broadcast(months), fact.RunMonth == F.col("_ym"), "left_semi")
