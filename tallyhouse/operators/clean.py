"""Bronze -> silver cleansing per entity.

Each ``stage_*`` types and trims the raw text columns; each ``clean_*`` adds
the keep-first flag and routes rows with the entity's checks, in the
reference's REASON precedence.  Raw inputs must carry ``_rid`` (see dq).
The REASON texts are fixed values: they must equal the reference's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators.dq import (FIRST, RID, Check, Routed, first_rows, keep_first, mark_first,
                                     profile_aggs, route)

# ----------------------------------------------------------------- orders
ORDER_KEY = ["SalesOrderID", "SalesOrderDetailID"]
ORDER_COLS = ["SalesOrderID", "SalesOrderDetailID", "OrderDate", "EmployeeID", "CustomerID",
              "ProductID", "StoreID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal",
              "SubTotal", "TaxAmt", "Freight", "TotalDue"]
_ORDER_INTS = ["SalesOrderID", "SalesOrderDetailID", "EmployeeID", "CustomerID", "ProductID",
               "StoreID", "OrderQty"]
_ORDER_DOUBLES = ["UnitPrice", "UnitPriceDiscount", "LineTotal", "SubTotal", "TaxAmt", "Freight",
                  "TotalDue"]
# latest OrderDate first, then every other output column as tie-break
ORDER_SORT = [("OrderDate", "desc")] + [(c, "asc") for c in ORDER_COLS[3:]]


def stage_orders(raw: DataFrame) -> DataFrame:
    cols = {c: X.safe_int(c) for c in _ORDER_INTS}
    cols.update({c: X.safe_double(c) for c in _ORDER_DOUBLES})
    cols["OrderDate"] = X.parse_mdy_ts("OrderDate")
    extra = [c for c in raw.columns if c not in cols and c not in ("DueDate", "ShipDate")]
    return raw.select(*[cols[c].alias(c) for c in ORDER_COLS], *extra)


def order_checks() -> list[Check]:
    c = F.col
    return [
        Check("pk", c("SalesOrderID").isNotNull() & c("SalesOrderDetailID").isNotNull(), "PK_NULL"),
        Check("date", c("OrderDate").isNotNull(), "BAD_ORDERDATE"),
        Check("dedup", c(FIRST), "DUPLICATE_PK"),
        Check("qty", c("OrderQty") > 0, "QTY_LE_0"),
        Check("price", c("UnitPrice") >= 0, "PRICE_LT_0"),
        Check("disc", (c("UnitPriceDiscount") >= 0) & (c("UnitPriceDiscount") <= 1),
              "DISCOUNT_OUT_OF_RANGE"),
        Check("nonneg", (c("SubTotal") >= 0) & (c("TaxAmt") >= 0) & (c("Freight") >= 0)
              & (c("TotalDue") >= 0) & (c("LineTotal") >= 0), "NEGATIVE_AMOUNTS"),
        Check("line", F.abs(c("LineTotal") - c("OrderQty") * c("UnitPrice")
                            * (F.lit(1) - c("UnitPriceDiscount"))) <= 0.01, "LINE_MISMATCH"),
        Check("total", F.abs(c("TotalDue") - (c("SubTotal") + c("TaxAmt") + c("Freight"))) <= 0.01,
              "TOTAL_MISMATCH"),
    ]


def dedup_orders(staged: DataFrame) -> DataFrame:
    return mark_first(staged, ORDER_KEY, ORDER_SORT)


def clean_orders(raw: DataFrame, null_policy: str = "parity") -> Routed:
    """Valid / invalid orders; DueDate and ShipDate are dropped."""
    s = stage_orders(raw)
    checks = order_checks()
    return route(dedup_orders(s), checks, ORDER_COLS, ORDER_COLS, null_policy,
                 firsts=first_rows(s, ORDER_KEY, ORDER_SORT, extra_aggs=profile_aggs(checks)))


def latest_orders(raw: DataFrame) -> DataFrame:
    """W1 alone: one row per order line key, the latest by OrderDate."""
    return keep_first(stage_orders(raw), ORDER_KEY, ORDER_SORT).select(*ORDER_COLS)


# -------------------------------------------------------------- customers
CUSTOMER_COLS = ["CustomerID", "FirstName", "LastName", "FullName"]
CUSTOMER_SORT = [("FullName", "asc"), ("FirstName", "asc"), ("LastName", "asc")]


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select(X.safe_int("CustomerID").alias("CustomerID"),
                      *[X.trim_ws(c).alias(c) for c in CUSTOMER_COLS[1:]], RID)


def _pk_dup_checks(pk: str) -> list[Check]:
    return [Check("pk", F.col(pk).isNotNull(), "PK_NULL_OR_NOT_INT"),
            Check("dedup", F.col(FIRST), "DUPLICATE_PK")]


def clean_customers(raw: DataFrame) -> Routed:
    st = stage_customers(raw)
    s = mark_first(st, ["CustomerID"], CUSTOMER_SORT)
    return route(s, _pk_dup_checks("CustomerID"), CUSTOMER_COLS, CUSTOMER_COLS,
                 firsts=first_rows(st, ["CustomerID"], CUSTOMER_SORT))


def first_customers(raw: DataFrame) -> DataFrame:
    """W2 alone: first customer row per id by trimmed FullName."""
    return keep_first(stage_customers(raw), ["CustomerID"], CUSTOMER_SORT).select(*CUSTOMER_COLS)


# -------------------------------------------------------------- employees (D3)
EMPLOYEE_COLS = ["EmployeeID", "ManagerID", "FirstName", "LastName", "FullName", "JobTitle",
                 "OrganizationLevel", "MaritalStatus", "Gender", "Territory", "Country", "GroupCol"]
EMPLOYEE_SORT = [("FullName", "asc")] + [(c, "asc") for c in EMPLOYEE_COLS[1:] if c != "FullName"]


def stage_employees(raw: DataFrame) -> DataFrame:
    ints = {"EmployeeID", "ManagerID", "OrganizationLevel"}
    upper = {"MaritalStatus", "Gender"}
    cols = []
    for c in EMPLOYEE_COLS:
        if c in ints:
            cols.append(X.safe_int(c).alias(c))
        elif c in upper:
            cols.append(F.upper(X.trim_ws(c)).alias(c))
        else:
            cols.append(X.trim_ws(c).alias(c))
    return raw.select(*cols, RID).withColumns({
        "GenderNorm": X.gender_code("Gender"),
        "MaritalNorm": X.marital_code("MaritalStatus"),
    })


def clean_employees(raw: DataFrame) -> Routed:
    st = stage_employees(raw)
    s = mark_first(st, ["EmployeeID"], EMPLOYEE_SORT)
    checks = _pk_dup_checks("EmployeeID") + [
        Check("gender", F.col("GenderNorm").isin("M", "F"), "GENDER_INVALID"),
        Check("marital", F.col("MaritalNorm").isin("S", "M"), "MARITALSTATUS_INVALID"),
    ]
    common = ["EmployeeID", "ManagerID", "FirstName", "LastName", "FullName", "JobTitle",
              "OrganizationLevel"]
    valid = common + [F.col("MaritalNorm").alias("MaritalStatus"), F.col("GenderNorm").alias("Gender"),
                      "Territory", "Country", F.col("GroupCol").alias("Group")]
    invalid = common + ["MaritalStatus", "Gender", "Territory", "Country",
                        F.col("GroupCol").alias("Group")]
    return route(s, checks, valid, invalid,
                 firsts=first_rows(st, ["EmployeeID"], EMPLOYEE_SORT))


# ----------------------------------------------------------------- stores
STORE_COLS = ["StoreID", "StoreName", "EmployeeID", "Budget"]


def stage_stores(raw_stores: DataFrame) -> DataFrame:
    """StoreID uses the strict cast: bad text fails the run, as in the reference."""
    return raw_stores.select(X.strict_int("StoreID").alias("StoreID"),
                             X.trim_ws("StoreName").alias("StoreName"),
                             X.safe_int("EmployeeID").alias("EmployeeID"), RID)


def stage_budgets(raw_budgets: DataFrame) -> DataFrame:
    return raw_budgets.select(X.strict_int("StoreID").alias("StoreID"),
                              X.safe_decimal("Budget", 18, 2).alias("BudgetRaw"),
                              F.col("Budget").alias("BudgetText"))


def store_budget_join(raw_stores: DataFrame, raw_budgets: DataFrame) -> DataFrame:
    """Stores LEFT JOIN budgets USING (StoreID); missing budget -> 0.00.

    Budgets are not deduplicated, so a store with two budget rows appears
    twice even where it is the first row of its key.  The join is left to
    Catalyst/AQE: it broadcasts the budget side only when its measured size
    is under the configured threshold.
    """
    return _with_budget(mark_first(stage_stores(raw_stores), ["StoreID"], STORE_SORT), raw_budgets)


STORE_SORT = [("StoreName", "asc"), ("EmployeeID", "asc")]


def _with_budget(stores: DataFrame, raw_budgets: DataFrame) -> DataFrame:
    j = stores.join(stage_budgets(raw_budgets), on="StoreID", how="left")
    return j.withColumn("Budget", F.coalesce(F.col("BudgetRaw"), F.lit(0).cast("decimal(18,2)")))


def budget_default_audit(joined: DataFrame) -> DataFrame:
    """SURVEY 7.4 #14: stores whose budget text was present but unparsable (or
    overflowing) and therefore became 0.00 silently, next to the missing ones."""
    text = X.trim_ws("BudgetText")
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("BudgetText").isNull(), 1)).alias("no_budget_row"),
        F.count(F.when(text.isNotNull() & (text != "") & F.col("BudgetRaw").isNull(), 1))
        .alias("unparsable_to_zero"),
        F.count(F.when(F.col("BudgetRaw") < 0, 1)).alias("negative"))


def clean_stores(raw_stores: DataFrame, raw_budgets: DataFrame) -> Routed:
    j = store_budget_join(raw_stores, raw_budgets)
    checks = [
        Check("pk", F.col("StoreID").isNotNull(), "PK_NULL"),
        Check("dedup", F.col(FIRST), "DUPLICATE_PK"),
        Check("budget", F.col("BudgetRaw").isNull() | (F.col("BudgetRaw") >= 0), "BUDGET_INVALID"),
    ]
    firsts = _with_budget(first_rows(stage_stores(raw_stores), ["StoreID"], STORE_SORT), raw_budgets)
    # the budget join fans rows out, so group sizes of stores do not count routed rows
    return route(j, checks, STORE_COLS, STORE_COLS, firsts=firsts, audit_from_firsts=False)


# --------------------------------------------------------- product family
CATEGORY_COLS = ["CategoryID", "CategoryName"]
SUBCATEGORY_COLS = ["SubCategoryID", "CategoryID", "SubCategoryName"]
PRODUCT_COLS = ["ProductID", "ProductNumber", "ProductName", "ModelName", "MakeFlag",
                "StandardCost", "ListPrice", "SubCategoryID"]


def stage_categories(raw: DataFrame) -> DataFrame:
    return raw.select(X.safe_int("CategoryID").alias("CategoryID"),
                      X.trim_ws("CategoryName").alias("CategoryName"), RID)


def clean_categories(raw: DataFrame) -> Routed:
    st = stage_categories(raw)
    s = mark_first(st, ["CategoryID"], [("CategoryName", "asc")])
    return route(s, _pk_dup_checks("CategoryID"), CATEGORY_COLS, CATEGORY_COLS,
                 firsts=first_rows(st, ["CategoryID"], [("CategoryName", "asc")]))


def stage_subcategories(raw: DataFrame) -> DataFrame:
    return raw.select(X.safe_int("SubCategoryID").alias("SubCategoryID"),
                      X.safe_int("CategoryID").alias("CategoryID"),
                      X.trim_ws("SubCategoryName").alias("SubCategoryName"), RID)


def clean_subcategories(raw: DataFrame) -> Routed:
    st = stage_subcategories(raw)
    order = [("SubCategoryName", "asc"), ("CategoryID", "asc")]
    s = mark_first(st, ["SubCategoryID"], order)
    checks = _pk_dup_checks("SubCategoryID") + [
        Check("cat_fk", F.col("CategoryID").isNotNull(), "CAT_FK_NULL_OR_NOT_INT")]
    return route(s, checks, SUBCATEGORY_COLS, SUBCATEGORY_COLS,
                 firsts=first_rows(st, ["SubCategoryID"], order))


def stage_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        X.safe_int("ProductID").alias("ProductID"),
        X.trim_ws("ProductNumber").alias("ProductNumber"),
        X.trim_ws("ProductName").alias("ProductName"),
        X.blank_to_null("ModelName").alias("ModelName"),
        X.flag_true("MakeFlag").alias("MakeFlag"),
        X.safe_double("StandardCost").alias("StandardCost"),
        X.safe_double("ListPrice").alias("ListPrice"),
        X.safe_int("SubCategoryID").alias("SubCategoryID"),
        RID,
    )


PRODUCT_SORT = [("ProductName", "asc")] + [(c, "asc") for c in PRODUCT_COLS[1:] if c != "ProductName"]


def clean_products(raw: DataFrame) -> Routed:
    st = stage_products(raw)
    s = mark_first(st, ["ProductID"], PRODUCT_SORT)
    checks = _pk_dup_checks("ProductID") + [
        Check("subcat_fk", F.col("SubCategoryID").isNotNull(), "SUBCAT_FK_NULL_OR_NOT_INT")]
    return route(s, checks, PRODUCT_COLS, PRODUCT_COLS,
                 firsts=first_rows(st, ["ProductID"], PRODUCT_SORT))
