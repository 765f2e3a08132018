"""Source manifest (S7, P13, D8): read the JSON manifest with Spark, select
sources, and the built-in default rule set.

The manifest is a small control document; reading it with
``spark.read.json(multiLine=True)`` keeps the path Spark-readable (object
stores included).  Its ``sources`` array is exploded to one row per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The reference manifest's per-table keys and data rules, in
# manifest order (table, pk, fk, dq_rules).
# ---------------------------------------------------------------------------
DEFAULT_RULES = [
    ("customers", ["CustomerID"], [], ["not_null:CustomerID"]),
    ("employee", ["EmployeeID"], [], ["not_null:EmployeeID"]),
    ("orders", ["SalesOrderID", "SalesOrderDetailID"], ["EmployeeID", "CustomerID", "ProductID", "StoreID"],
     ["not_null:SalesOrderID", "not_null:SalesOrderDetailID", "valid_date:OrderDate"]),
    ("productCategories", ["CategoryID"], [], ["not_null:CategoryID"]),
    ("products", ["ProductID"], ["SubCategoryID"], ["not_null:ProductID"]),
    ("productSubcategories", ["SubCategoryID"], ["CategoryID"], ["not_null:SubCategoryID"]),
    ("stores", ["StoreID"], ["EmployeeID"], ["not_null:StoreID"]),
    ("storesBudget", ["StoreID"], [], ["not_null:StoreID", "gte_zero:Budget"]),
]
# ---------------------------------------------------------------------------

SOURCE_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("url_or_query", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("date_field", T.StringType()),
    T.StructField("date_format", T.StringType()),
    T.StructField("target_bronze_prefix", T.StringType()),
    T.StructField("partitioning", T.StringType()),
    T.StructField("secret_name", T.StringType()),
    T.StructField("excel_source_prefix", T.StringType()),
    T.StructField("pk", T.ArrayType(T.StringType())),
    T.StructField("fk", T.ArrayType(T.StringType())),
    T.StructField("dq_rules", T.ArrayType(T.StringType())),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_defaults", T.StructType([
        T.StructField("allow_overwrite", T.BooleanType()),
        T.StructField("months_partitioning", T.StringType()),
    ])),
    T.StructField("sources", T.ArrayType(SOURCE_SCHEMA)),
])


def load_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Return (sources: one row per source, run_defaults: one row)."""
    doc = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    sources = doc.select(F.explode("sources").alias("s")).select("s.*")
    defaults = doc.select("run_defaults.*")
    return sources, defaults


def select_sources(sources: DataFrame, type_: str | None = None,
                   table: str | None = None) -> DataFrame:
    """Sources by ``type`` and/or ``table``."""
    out = sources
    if type_ is not None:
        out = out.where(F.col("type") == type_)
    if table is not None:
        out = out.where(F.col("table") == table)
    return out


def first_source(sources: DataFrame, table: str) -> dict | None:
    """First manifest source describing ``table`` (a control-plane lookup on a
    document of a few rows), or None."""
    rows = select_sources(sources, table=table).limit(1).collect()
    return rows[0].asDict() if rows else None


def rules_from_sources(sources: DataFrame) -> list[tuple[str, list, list, list]]:
    """Turn a loaded manifest into the (table, pk, fk, dq_rules) list."""
    rows = sources.select("table", "pk", "fk", "dq_rules").collect()
    return [(r["table"], list(r["pk"] or []), list(r["fk"] or []), list(r["dq_rules"] or []))
            for r in rows]
