"""Registered queries: one per operator key of SURVEY section 7.5.

Each callable takes (spark, sf_dir) and returns a DataFrame built over the
driver's parquet tables through the fixture role views, so every query's
work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators import clean as C
from tallyhouse.operators import dq
from tallyhouse.operators import measures as M
from tallyhouse.operators import rollups as R
from tallyhouse.operators import views as V
from tallyhouse.operators import warehouse as W
from tallyhouse.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (fixed inputs, not data).
SCAN_MONTH = "1996-02"
BACKFILL_MONTHS = ["1996-02", "1996-03", "1996-04"]
LOADED_UNTIL = "1998-12"      # fact split: months <= this are already loaded
INCOMING_FROM = "1998-06"     # incoming feed overlaps the loaded months
CALENDAR_START = "1995-01"    # scheduler bounds over the data's period
CALENDAR_END = "2001-08"
LANDING_BUCKET = "sales-lake"

_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _raw(spark, sf, name):
    return FX.RAW[name](spark, sf)


def _fact(spark, sf):
    return W.fact_projection(_raw(spark, sf, "raw_orders"))


def _silver_dims(spark, sf):
    return {
        "customer": W.silver_dim_customer(_raw(spark, sf, "raw_customers")),
        "employee": W.silver_dim_employee(_raw(spark, sf, "raw_employees")),
        "store": W.silver_dim_store(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets")),
        "product": W.silver_dim_product(_raw(spark, sf, "raw_products"),
                                        _raw(spark, sf, "raw_subcategories"),
                                        _raw(spark, sf, "raw_categories")),
    }


def _direct_dims(spark, sf):
    return {
        "customer": W.dim_customer_load(_raw(spark, sf, "raw_customers")),
        "employee": W.dim_employee_load(_raw(spark, sf, "raw_employees")),
        "store": W.dim_store_load(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets")),
        "product": W.dim_product_flatten(_raw(spark, sf, "raw_products"),
                                         _raw(spark, sf, "raw_subcategories"),
                                         _raw(spark, sf, "raw_categories")),
    }


RAW_ORDER_COLS = ["SalesOrderID", "SalesOrderDetailID", "OrderDate", "DueDate", "ShipDate",
                  "EmployeeID", "CustomerID", "SubTotal", "TaxAmt", "Freight", "TotalDue",
                  "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal", "StoreID"]


# ------------------------------------------------------------------ scans
@register("scan_parquet")
def q_scan_parquet(spark, sf):
    """Pruned parquet scan (four of eleven columns reach the reader)."""
    return FX.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                   "l_shipdate")


@register("preview_limit")
def q_preview_limit(spark, sf):
    """O2: LIMIT 5 preview, ordered first so it is deterministic (a top-k)."""
    return W.dim_customer_load(_raw(spark, sf, "raw_customers")).orderBy(
        "CustomerKey", "FullName").limit(5)


@register("scan_month_partition")
def q_scan_month_partition(spark, sf):
    """Rows of one year/month partition, month split from YYYY-MM."""
    r = _raw(spark, sf, "raw_orders")
    y, m = SCAN_MONTH.split("-")
    r = r.withColumns({"year": X.month_year("RunMonth"), "month": X.month_number("RunMonth"),
                       "month_z": X.month_padded("RunMonth")})
    return r.where((F.col("year") == int(y)) & (F.col("month") == int(m))).select(
        *RAW_ORDER_COLS, "year", "month", "month_z")


@register("ingest_month_filter")
def q_ingest_month_filter(spark, sf):
    """Order rows whose text date falls in the run month (format cascade)."""
    r = _raw(spark, sf, "raw_orders")
    r = r.withColumn("DateText", _mixed_date_text())
    return r.where(X.in_run_month("DateText", SCAN_MONTH, "MM-dd-yyyy")).select(
        *RAW_ORDER_COLS, "DateText")


def _mixed_date_text():
    """The order date written in the five shapes the cascade must read, chosen
    per row; some with a time part or surrounding blanks.  A function of the
    parsed date (array of one), so that a row's date is parsed once, wherever
    the text is used."""
    def written(d):
        k = (F.col("SalesOrderDetailID").cast("int") + F.dayofmonth(d)) % 7
        return (F.when(d.isNull(), F.col("OrderDate"))
                .when(k == 0, F.date_format(d, "yyyy-MM-dd"))
                .when(k == 1, F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit(" 10:00:00")))
                .when(k == 2, F.date_format(d, "dd-MM-yyyy"))
                .when(k == 3, F.concat(F.lit(" "), F.date_format(d, "MM/dd/yyyy"), F.lit("T08:00")))
                .when(k == 4, F.date_format(d, "MM-dd-yyyy"))
                .when(k == 5, F.date_format(d, "M-d-yyyy"))
                .otherwise(F.col("OrderDate")))
    return F.transform(F.array(X.parse_mdy("OrderDate")), written)[0]


@register("backfill_months")
def q_backfill_months(spark, sf):
    """One pass over the feed for several months, tagged by run month."""
    r = _raw(spark, sf, "raw_orders")
    pm = X.parsed_month("OrderDate", "MM-dd-yyyy")
    return r.withColumn("run_month", pm).where(pm.isin(BACKFILL_MONTHS)).select(
        *RAW_ORDER_COLS, "run_month")


# ---------------------------------------------------------------- scalars
@register("scalar_safe_cast")
def q_scalar_safe_cast(spark, sf):
    r = _raw(spark, sf, "raw_orders")
    return r.select(
        "SalesOrderID", "OrderQty", "UnitPrice", "Freight",
        X.safe_int("SalesOrderID").alias("SalesOrderID_int"),
        X.safe_int("OrderQty").alias("OrderQty_int"),
        X.safe_double("UnitPrice").alias("UnitPrice_double"),
        X.safe_double("UnitPriceDiscount").alias("UnitPriceDiscount_double"),
        X.safe_decimal("Freight", 18, 2).alias("Freight_decimal"),
        X.safe_int("UnitPriceDiscount").alias("UnitPriceDiscount_int"))


@register("scalar_date_parse")
def q_scalar_date_parse(spark, sf):
    r = _raw(spark, sf, "raw_orders")
    return r.select("OrderDate", "ShipDate",
                    X.parse_mdy_ts("OrderDate").alias("OrderDate_ts"),
                    X.parse_mdy("ShipDate").alias("ShipDate_date"))


# ---------------------------------------------------------------- orders D1
@register("orders_check_flags")
def q_orders_check_flags(spark, sf):
    routed = C.clean_orders(_raw(spark, sf, "raw_orders"))
    flags = [f"ok_{c.name}" for c in C.order_checks()]
    return routed.flagged.select(*C.ORDER_COLS, *flags)


@register("orders_amount_reconcile")
def q_orders_amount_reconcile(spark, sf):
    s = C.stage_orders(_raw(spark, sf, "raw_orders"))
    c = F.col
    return s.select(
        "SalesOrderID", "SalesOrderDetailID", "LineTotal", "TotalDue",
        (F.abs(c("LineTotal") - c("OrderQty") * c("UnitPrice") * (F.lit(1) - c("UnitPriceDiscount")))
         <= 0.01).alias("line_ok"),
        (F.abs(c("TotalDue") - (c("SubTotal") + c("TaxAmt") + c("Freight"))) <= 0.01).alias("total_ok"))


@register("orders_dedup_latest")
def q_orders_dedup_latest(spark, sf):
    return C.latest_orders(_raw(spark, sf, "raw_orders"))


@register("orders_valid")
def q_orders_valid(spark, sf):
    return C.clean_orders(_raw(spark, sf, "raw_orders")).valid()


@register("orders_invalid")
def q_orders_invalid(spark, sf):
    return C.clean_orders(_raw(spark, sf, "raw_orders")).invalid()


@register("orders_reason_profile")
def q_orders_reason_profile(spark, sf):
    return C.clean_orders(_raw(spark, sf, "raw_orders")).reason_profile()


@register("orders_split_audit")
def q_orders_split_audit(spark, sf):
    return C.clean_orders(_raw(spark, sf, "raw_orders")).audit("orders")


# ------------------------------------------------------------- customers D2
@register("customer_valid")
def q_customer_valid(spark, sf):
    return C.clean_customers(_raw(spark, sf, "raw_customers")).valid()


@register("customer_invalid")
def q_customer_invalid(spark, sf):
    return C.clean_customers(_raw(spark, sf, "raw_customers")).invalid()


@register("dim_customer_load")
def q_dim_customer_load(spark, sf):
    return W.dim_customer_load(_raw(spark, sf, "raw_customers"))


@register("dim_dedup_first")
def q_dim_dedup_first(spark, sf):
    return C.first_customers(_raw(spark, sf, "raw_customers"))


# ------------------------------------------------------------- employees D3
@register("employee_normalise")
def q_employee_normalise(spark, sf):
    s = C.stage_employees(_raw(spark, sf, "raw_employees"))
    return s.select("EmployeeID", "Gender", "MaritalStatus", "GenderNorm", "MaritalNorm")


@register("employee_valid")
def q_employee_valid(spark, sf):
    return C.clean_employees(_raw(spark, sf, "raw_employees")).valid()


@register("employee_invalid")
def q_employee_invalid(spark, sf):
    return C.clean_employees(_raw(spark, sf, "raw_employees")).invalid()


@register("dim_employee_load")
def q_dim_employee_load(spark, sf):
    return W.dim_employee_load(_raw(spark, sf, "raw_employees"))


# ---------------------------------------------------------------- stores D4
@register("store_budget_join")
def q_store_budget_join(spark, sf):
    j = C.store_budget_join(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))
    return j.select("StoreID", "StoreName", "EmployeeID", "Budget",
                    F.col("BudgetRaw").isNotNull().alias("has_budget"),
                    F.col(dq.FIRST).alias("is_first"))


@register("store_valid")
def q_store_valid(spark, sf):
    return C.clean_stores(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets")).valid()


@register("store_invalid")
def q_store_invalid(spark, sf):
    return C.clean_stores(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets")).invalid()


@register("dim_store_load")
def q_dim_store_load(spark, sf):
    return W.dim_store_load(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))


@register("budget_clean")
def q_budget_clean(spark, sf):
    """Money texts normalised; rows without id or amount skipped."""
    from tallyhouse.sources.external import budget_rows
    out = budget_rows(_raw(spark, sf, "raw_money"), "StoreID", "Budget")
    return out.select("StoreID", "BudgetText", "Budget",
                      X.safe_decimal("Budget", 18, 2).alias("BudgetValue"))


# ------------------------------------------------------- product family D5-D7
@register("category_valid")
def q_category_valid(spark, sf):
    return C.clean_categories(_raw(spark, sf, "raw_categories")).valid()


@register("category_invalid")
def q_category_invalid(spark, sf):
    return C.clean_categories(_raw(spark, sf, "raw_categories")).invalid()


@register("subcategory_valid")
def q_subcategory_valid(spark, sf):
    return C.clean_subcategories(_raw(spark, sf, "raw_subcategories")).valid()


@register("subcategory_invalid")
def q_subcategory_invalid(spark, sf):
    return C.clean_subcategories(_raw(spark, sf, "raw_subcategories")).invalid()


@register("product_clean")
def q_product_clean(spark, sf):
    s = C.stage_products(_raw(spark, sf, "raw_products"))
    return s.select("ProductID", "ModelName", "MakeFlag")


@register("product_valid")
def q_product_valid(spark, sf):
    return C.clean_products(_raw(spark, sf, "raw_products")).valid()


@register("product_invalid")
def q_product_invalid(spark, sf):
    return C.clean_products(_raw(spark, sf, "raw_products")).invalid()


@register("dim_product_flatten")
def q_dim_product_flatten(spark, sf):
    return W.dim_product_flatten(_raw(spark, sf, "raw_products"),
                                 _raw(spark, sf, "raw_subcategories"),
                                 _raw(spark, sf, "raw_categories"))


# --------------------------------------------------- manifest rules, FK check
@register("dq_manifest_rules")
def q_dq_manifest_rules(spark, sf):
    from tallyhouse.plans.rules import manifest_rule_report
    return manifest_rule_report(spark, sf)


@register("fk_orphans")
def q_fk_orphans(spark, sf):
    from tallyhouse.plans.rules import fk_orphan_report
    return fk_orphan_report(spark, sf)


# ----------------------------------------------------------- fact and loads
@register("fact_projection")
def q_fact_projection(spark, sf):
    return _fact(spark, sf)


@register("fact_from_silver")
def q_fact_from_silver(spark, sf):
    """L5 after D1: the fact as the pipeline loads it, from validated orders."""
    return W.fact_from_silver(C.clean_orders(_raw(spark, sf, "raw_orders")).valid())


@register("fact_month_counts")
def q_fact_month_counts(spark, sf):
    return _fact(spark, sf).groupBy("RunMonth").agg(F.count(F.lit(1)).alias("n"))


@register("control_log_summary")
def q_control_log_summary(spark, sf):
    from tallyhouse.plans.loads import control_log_summary
    return control_log_summary(_raw(spark, sf, "raw_orders"))


@register("fact_new_months")
def q_fact_new_months(spark, sf):
    from tallyhouse.plans.loads import month_load_protocol
    fact = _fact(spark, sf)
    loaded = fact.where(F.col("RunMonth") <= LOADED_UNTIL)
    incoming = fact.where(F.col("RunMonth") >= INCOMING_FROM)
    return month_load_protocol(incoming, loaded)


@register("next_run_month")
def q_next_run_month(spark, sf):
    from tallyhouse.plans.loads import next_run_month_scenarios
    return next_run_month_scenarios(_raw(spark, sf, "raw_orders"), LOADED_UNTIL,
                                    CALENDAR_START, CALENDAR_END)


@register("classify_keys")
def q_classify_keys(spark, sf):
    from tallyhouse.plans.loads import landing_keys
    keys = landing_keys(FX.table(spark, sf, "orders"), LANDING_BUCKET)
    st = X.classify_key("bucket", "key", LANDING_BUCKET)
    rm = F.when(st == "ACCEPTED", X.month_from_key("key"))
    return keys.select(st.alias("status"), rm.alias("run_month")).groupBy("status", "run_month").agg(
        F.count(F.lit(1)).alias("n_keys"))


# ------------------------------------------------------------------ views
@register("v_sales")
def q_v_sales(spark, sf):
    d = _direct_dims(spark, sf)
    return V.v_sales(_fact(spark, sf), d["customer"], d["employee"], d["store"], d["product"], counted=True)


@register("v_dim_store")
def q_v_dim_store(spark, sf):
    return V.v_dim_store(_direct_dims(spark, sf)["store"])


@register("v_calendar_month_loaded")
def q_v_calendar_month_loaded(spark, sf):
    return V.v_calendar_month_loaded(_fact(spark, sf)).orderBy("MonthDate")


# --------------------------------------------------------------- measures
@register("total_sales")
def q_total_sales(spark, sf):
    return M.total_sales(_fact(spark, sf))


@register("total_sales_header")
def q_total_sales_header(spark, sf):
    return M.total_sales_header(_fact(spark, sf))


@register("units_sold")
def q_units_sold(spark, sf):
    return M.units_sold(_fact(spark, sf))


@register("budget_compliance")
def q_budget_compliance(spark, sf):
    st = W.silver_dim_store(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))
    return M.budget_compliance(_fact(spark, sf), st)


@register("cumulative_sales")
def q_cumulative_sales(spark, sf):
    e = W.silver_dim_employee(_raw(spark, sf, "raw_employees"))
    return M.cumulative_sales(_fact(spark, sf), e)


@register("gross_margin")
def q_gross_margin(spark, sf):
    p = _silver_dims(spark, sf)["product"]
    return M.gross_margin(_fact(spark, sf), p)


@register("store_compliance_bands")
def q_store_compliance_bands(spark, sf):
    st = W.silver_dim_store(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))
    return M.store_compliance_bands(_fact(spark, sf), st)


@register("margin_by_country")
def q_margin_by_country(spark, sf):
    d = _silver_dims(spark, sf)
    return M.margin_by_country(_fact(spark, sf), d["employee"], d["product"])


@register("store_diversity")
def q_store_diversity(spark, sf):
    st = W.silver_dim_store(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))
    return M.store_diversity(_fact(spark, sf), st)


@register("sales_by_month_country")
def q_sales_by_month_country(spark, sf):
    e = W.silver_dim_employee(_raw(spark, sf, "raw_employees"))
    return M.sales_by_month_country(_fact(spark, sf), e)


# ------------------------------------- measures from the months' partial sums
@register("rollup_total_sales")
def q_rollup_total_sales(spark, sf):
    return R.total_sales(R.partials(_fact(spark, sf)))


@register("rollup_gross_margin")
def q_rollup_gross_margin(spark, sf):
    return R.gross_margin(R.partials(_fact(spark, sf)), _silver_dims(spark, sf)["product"])


@register("rollup_margin_by_country")
def q_rollup_margin_by_country(spark, sf):
    d = _silver_dims(spark, sf)
    return R.margin_by_country(R.partials(_fact(spark, sf)), d["employee"], d["product"])


@register("rollup_store_diversity")
def q_rollup_store_diversity(spark, sf):
    st = W.silver_dim_store(_raw(spark, sf, "raw_stores"), _raw(spark, sf, "raw_budgets"))
    return R.store_diversity(R.partials(_fact(spark, sf)), st)
