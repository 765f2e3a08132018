"""Star schema: typed external reads, dimension loads, fact projection.

``source='bronze'`` is the reference's direct warehouse path (typed text, no
DQ, no dedup); ``source='silver'`` maps the validated silver outputs onto the
same warehouse schemas (unique keys, so star joins do not fan out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators import clean as C

# Typed external tables (S2): declared types, unparsable text -> NULL.
TYPED = {
    "orders": {"SalesOrderID": "int", "SalesOrderDetailID": "int", "OrderDate": "string",
               "DueDate": "string", "ShipDate": "string", "EmployeeID": "int", "CustomerID": "int",
               "SubTotal": "double", "TaxAmt": "double", "Freight": "double", "TotalDue": "double",
               "ProductID": "int", "OrderQty": "int", "UnitPrice": "double",
               "UnitPriceDiscount": "double", "LineTotal": "double", "StoreID": "int"},
    "customers": {"CustomerID": "int", "FirstName": "string", "LastName": "string",
                  "FullName": "string"},
    "employees": {"EmployeeID": "int", "ManagerID": "int", "FirstName": "string",
                  "LastName": "string", "FullName": "string", "JobTitle": "string",
                  "OrganizationLevel": "int", "MaritalStatus": "string", "Gender": "string",
                  "Territory": "string", "Country": "string", "GroupCol": "string"},
    "stores": {"StoreID": "int", "StoreName": "string", "EmployeeID": "int"},
    "stores_budget": {"StoreID": "int", "Budget": "double"},
    "products": {"ProductID": "int", "ProductNumber": "string", "ProductName": "string",
                 "ModelName": "string", "MakeFlag": "int", "StandardCost": "double",
                 "ListPrice": "double", "SubCategoryID": "int"},
    "product_subcategories": {"SubCategoryID": "int", "CategoryID": "int",
                              "SubCategoryName": "string"},
    "product_categories": {"CategoryID": "int", "CategoryName": "string"},
}


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Apply a typed external-table schema to all-string raw columns."""
    casts = {"int": X.safe_int, "double": X.safe_double}
    cols = [casts[t](c).alias(c) if t in casts else F.col(c) for c, t in TYPED[table].items()]
    extra = [c for c in raw.columns if c not in TYPED[table]]
    return raw.select(*cols, *extra)


# --------------------------------------------------------------- direct path
def dim_customer_load(raw_customers: DataFrame) -> DataFrame:
    t = typed(raw_customers, "customers")
    return t.where(F.col("CustomerID").isNotNull()).select(
        F.col("CustomerID").alias("CustomerKey"),
        *[X.trim_ws(c).alias(c) for c in ("FirstName", "LastName", "FullName")])


def dim_employee_load(raw_employees: DataFrame) -> DataFrame:
    t = typed(raw_employees, "employees")
    return t.where(F.col("EmployeeID").isNotNull()).select(
        F.col("EmployeeID").alias("EmployeeKey"), "ManagerID",
        *[X.trim_ws(c).alias(c) for c in ("FirstName", "LastName", "FullName", "JobTitle")],
        "OrganizationLevel",
        F.upper(X.trim_ws("MaritalStatus")).alias("MaritalStatus"),
        F.upper(X.trim_ws("Gender")).alias("Gender"),
        *[X.trim_ws(c).alias(c) for c in ("Territory", "Country", "GroupCol")])


def dim_product_flatten(raw_products: DataFrame, raw_subcategories: DataFrame,
                        raw_categories: DataFrame) -> DataFrame:
    """Product LEFT JOIN subcategory LEFT JOIN category (snowflake flatten)."""
    p = typed(raw_products, "products").where(F.col("ProductID").isNotNull())
    ps = typed(raw_subcategories, "product_subcategories").select(
        F.col("SubCategoryID").alias("ps_SubCategoryID"), F.col("CategoryID").alias("ps_CategoryID"),
        "SubCategoryName")
    pc = typed(raw_categories, "product_categories").select(
        F.col("CategoryID").alias("pc_CategoryID"), "CategoryName")
    j = (p.join(ps, p.SubCategoryID == ps.ps_SubCategoryID, "left")
         .join(pc, F.col("ps_CategoryID") == pc.pc_CategoryID, "left"))
    return j.select(
        F.col("ProductID").alias("ProductKey"),
        X.trim_ws("ProductNumber").alias("ProductNumber"),
        X.trim_ws("ProductName").alias("ProductName"),
        X.trim_ws("ModelName").alias("ModelName"),
        F.col("MakeFlag").cast("int").alias("MakeFlag"),
        "StandardCost", "ListPrice", "SubCategoryID",
        X.trim_ws("SubCategoryName").alias("SubCategoryName"),
        F.col("ps_CategoryID").alias("CategoryID"),
        X.trim_ws("CategoryName").alias("CategoryName"))


def dim_store_load(raw_stores: DataFrame, raw_budgets: DataFrame) -> DataFrame:
    """Store LEFT JOIN budget; Budget stays NULL when absent."""
    s = typed(raw_stores, "stores").where(F.col("StoreID").isNotNull())
    b = typed(raw_budgets, "stores_budget").select(F.col("StoreID").alias("b_StoreID"), "Budget")
    return s.join(b, s.StoreID == b.b_StoreID, "left").select(
        F.col("StoreID").alias("StoreKey"), X.trim_ws("StoreName").alias("StoreName"),
        "EmployeeID", "Budget")


FACT_COLS = ["SalesOrderKey", "SalesOrderDetailKey", "OrderDate", "DueDate", "ShipDate",
             "EmployeeKey", "CustomerKey", "ProductKey", "StoreKey", "OrderQty", "UnitPrice",
             "UnitPriceDiscount", "SubTotal", "TaxAmt", "Freight", "TotalDue", "LineTotal",
             "RunMonth"]


def fact_projection(raw_orders: DataFrame, run_month=None) -> DataFrame:
    """Key renames, three safe date parses, RunMonth.

    ``run_month`` None keeps the feed's RunMonth column; a string stamps the
    constant month of a one-file load (P2).
    """
    t = typed(raw_orders, "orders")
    rm = F.lit(run_month) if isinstance(run_month, str) else F.col("RunMonth")
    return t.select(
        F.col("SalesOrderID").alias("SalesOrderKey"),
        F.col("SalesOrderDetailID").alias("SalesOrderDetailKey"),
        X.parse_mdy("OrderDate").alias("OrderDate"),
        X.parse_mdy("DueDate").alias("DueDate"),
        X.parse_mdy("ShipDate").alias("ShipDate"),
        F.col("EmployeeID").alias("EmployeeKey"),
        F.col("CustomerID").alias("CustomerKey"),
        F.col("ProductID").alias("ProductKey"),
        F.col("StoreID").alias("StoreKey"),
        "OrderQty", "UnitPrice", "UnitPriceDiscount", "SubTotal", "TaxAmt", "Freight",
        "TotalDue", "LineTotal", rm.alias("RunMonth"))


# --------------------------------------------------------------- silver path
def fact_from_silver(silver_orders: DataFrame, run_month: str | None = None) -> DataFrame:
    """L5 from validated orders (no invalid rows, one row per order line).

    Silver has no DueDate and ShipDate; they are NULL in the fact.  RunMonth is
    ``run_month``, or the month of the (never NULL) OrderDate.
    """
    names = {"SalesOrderID": "SalesOrderKey", "SalesOrderDetailID": "SalesOrderDetailKey", "EmployeeID": "EmployeeKey",
             "CustomerID": "CustomerKey", "ProductID": "ProductKey", "StoreID": "StoreKey"}
    out = silver_orders.withColumnsRenamed(names).withColumns({
        "RunMonth": F.lit(run_month) if run_month else F.date_format("OrderDate", "yyyy-MM"),
        "OrderDate": F.col("OrderDate").cast("date"),
        "DueDate": F.lit(None).cast("date"), "ShipDate": F.lit(None).cast("date")})
    return out.select(*FACT_COLS)


def silver_dim_customer(raw_customers: DataFrame) -> DataFrame:
    return C.clean_customers(raw_customers).valid().withColumnRenamed("CustomerID", "CustomerKey")


def silver_dim_employee(raw_employees: DataFrame) -> DataFrame:
    return (C.clean_employees(raw_employees).valid()
            .withColumnRenamed("EmployeeID", "EmployeeKey").withColumnRenamed("Group", "GroupCol"))


def silver_dim_store(raw_stores: DataFrame, raw_budgets: DataFrame) -> DataFrame:
    return C.clean_stores(raw_stores, raw_budgets).valid().withColumnRenamed("StoreID", "StoreKey")


def silver_dim_product(raw_products: DataFrame, raw_subcategories: DataFrame,
                       raw_categories: DataFrame) -> DataFrame:
    p = C.clean_products(raw_products).valid()
    s = C.clean_subcategories(raw_subcategories).valid()
    c = C.clean_categories(raw_categories).valid()
    return (p.join(s.select("SubCategoryID", "CategoryID", "SubCategoryName"), "SubCategoryID", "left")
            .join(c, "CategoryID", "left")
            .select(F.col("ProductID").alias("ProductKey"), "ProductNumber", "ProductName",
                    "ModelName", F.col("MakeFlag").cast("int").alias("MakeFlag"), "StandardCost",
                    "ListPrice", "SubCategoryID", "SubCategoryName", "CategoryID", "CategoryName"))


# ------------------------------------------------------- warehouse schemas
WAREHOUSE_SCHEMAS = {
    "fact_sales": ("SalesOrderKey int, SalesOrderDetailKey int, OrderDate date, DueDate date, "
                   "ShipDate date, EmployeeKey int, CustomerKey int, ProductKey int, StoreKey int, "
                   "OrderQty int, UnitPrice double, UnitPriceDiscount double, SubTotal double, "
                   "TaxAmt double, Freight double, TotalDue double, LineTotal double, RunMonth string"),
    "dim_customer": "CustomerKey int, FirstName string, LastName string, FullName string",
    "dim_employee": ("EmployeeKey int, ManagerID int, FirstName string, LastName string, "
                     "FullName string, JobTitle string, OrganizationLevel int, MaritalStatus string, "
                     "Gender string, Territory string, Country string, GroupCol string"),
    "dim_store": "StoreKey int, StoreName string, EmployeeID int, Budget double",
    "dim_product": ("ProductKey int, ProductNumber string, ProductName string, ModelName string, "
                    "MakeFlag int, StandardCost double, ListPrice double, SubCategoryID int, "
                    "SubCategoryName string, CategoryID int, CategoryName string"),
}


def read_warehouse(spark, path: str, table: str) -> DataFrame:
    """Parquet scan of a warehouse table with its declared schema, given to
    the reader: no footer is read to infer one.  ``to_warehouse`` wrote it so."""
    return spark.read.schema(WAREHOUSE_SCHEMAS[table]).parquet(path)


def to_warehouse(df: DataFrame, table: str) -> DataFrame:
    """Columns and types as declared (a silver Budget is DECIMAL, the table's DOUBLE)."""
    want = [f.split() for f in WAREHOUSE_SCHEMAS[table].split(", ")]
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in want])
