"""Source files for job/stream tests, written from the driver tables' role views."""

import csv
import os

from conftest import SF_SMALL
from tallyhouse.plans.queries import RAW_ORDER_COLS
from tallyhouse.sources import fixtures as FX
from tallyhouse.sources.bronze import RAW_COLUMNS

DIM_ROLES = {"customers": "raw_customers", "employees": "raw_employees", "stores": "raw_stores",
             "stores_budget": "raw_budgets", "products": "raw_products",
             "product_subcategories": "raw_subcategories", "product_categories": "raw_categories"}


def write_sources(spark, base):
    """orders.csv (whole feed) and one CSV per dimension, Spark-written."""
    out = {}
    o = FX.raw_orders(spark, SF_SMALL).select(*RAW_ORDER_COLS)
    out["orders"] = os.path.join(base, "src", "orders")
    o.coalesce(1).write.option("header", True).option("escape", '"').csv(out["orders"])
    for table, role in DIM_ROLES.items():
        p = os.path.join(base, "src", table)
        FX.RAW[role](spark, SF_SMALL).select(*RAW_COLUMNS[table]).coalesce(1).write.option(
            "header", True).option("escape", '"').csv(p)
        out[table] = p
    return out


def month_rows(spark, ym):
    """Raw order rows of one feed month, as Python rows (small test input)."""
    from pyspark.sql import functions as F
    return [tuple(r) for r in FX.raw_orders(spark, SF_SMALL).where(F.col("RunMonth") == ym)
            .select(*RAW_ORDER_COLS).collect()]


def write_month_file(path, rows):
    """One landed month file, as the ingester delivers it (single CSV)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(RAW_ORDER_COLS)
        w.writerows(rows)
