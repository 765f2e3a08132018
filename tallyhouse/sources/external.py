"""Other feeds: S4 JDBC query, S5 budget sheet, S6 inbox file pick.

Each is a distributed Spark read; only bounded control values (one header
row, one chosen path) ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators.dq import RID, with_row_id

# ---------------------------------------------------------------------------
# The store feed query and the budget-sheet header aliases
# (case-insensitive after trimming, first alias found wins).
# ---------------------------------------------------------------------------
STORES_QUERY = ("SELECT BusinessEntityID AS StoreID, Name AS StoreName, "
                "SalesPersonID AS EmployeeID FROM Store")
STORE_COLUMNS = ["StoreID", "StoreName", "EmployeeID"]
STORE_ID_ALIASES = ["storeid", "store_id", "id", "tienda", "store"]
BUDGET_ALIASES = ["budget", "presupuesto", "monto", "importe"]
# ---------------------------------------------------------------------------


def read_jdbc_query(spark: SparkSession, url: str, query: str = STORES_QUERY,
                    columns: list[str] | None = STORE_COLUMNS, properties: dict | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A pushed-down query over JDBC, renamed to the bronze column names
    (some databases upper-case aliases).  With ``partition_column`` the query is
    read as ``num_partitions`` parallel range slices."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", num_partitions or 1))
    else:
        r = r.option("query", query)
    df = r.load()
    return df.toDF(*columns) if columns else df


def _first_alias(headers: list[str], aliases: list[str]) -> int | None:
    for a in aliases:
        if a in headers:
            return headers.index(a)
    return None


def read_budget_sheet(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """S5 + F8 + P8: budget sheet as delimited text -> (StoreID, Budget) text.

    The header is the first line with at least two non-empty cells; StoreID and
    Budget columns are found by alias.  Data lines after it are kept when both
    cells are non-empty and the cleaned amount is non-empty.
    """
    lines = with_row_id(spark.read.text(path))
    cells = lines.select(RID, F.split("value", sep, -1).alias("c"))
    filled = F.size(F.filter("c", lambda x: x != F.lit("")))
    header = cells.where(filled >= 2).orderBy(RID).select(RID, "c").limit(1).collect()
    if not header:
        raise ValueError(f"no header line in budget sheet {path}")
    hdr_rid, hdr = header[0][RID], [h.strip().lower() for h in header[0]["c"]]
    i_sid, i_bud = _first_alias(hdr, STORE_ID_ALIASES), _first_alias(hdr, BUDGET_ALIASES)
    if i_sid is None or i_bud is None:
        raise ValueError(f"StoreID/Budget columns not found in header {hdr}")
    data = cells.where(F.col(RID) > hdr_rid).select(
        F.get(F.col("c"), i_sid).alias("sid"), F.get(F.col("c"), i_bud).alias("bud"))
    return budget_rows(data, "sid", "bud").select("StoreID", "Budget")


def budget_rows(df: DataFrame, sid: str, bud: str) -> DataFrame:
    """P8 + F8: (StoreID, BudgetText, Budget) for rows with both cells present;
    a row whose id trims to nothing or whose amount cleans to nothing is skipped."""
    out = df.where(F.col(sid).isNotNull() & (F.col(sid) != "")
                   & F.col(bud).isNotNull() & (F.col(bud) != "")).select(
        X.trim_ws(sid).alias("StoreID"), F.col(bud).alias("BudgetText"),
        X.clean_money(bud).alias("Budget"))
    return out.where((F.col("StoreID") != "") & F.col("Budget").isNotNull() & (F.col("Budget") != ""))


def pick_inbox_file(spark: SparkSession, directory: str, suffix: str = ".xlsx") -> str:
    """First path (sort order) whose lower-cased name ends with ``suffix``.
    Only the file listing is read (the content column is pruned)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
             .select("path"))
    first = files.where(F.lower("path").endswith(suffix.lower())).agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no *{suffix} file under {directory}")
    return first
