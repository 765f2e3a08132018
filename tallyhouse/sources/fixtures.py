"""Driver tables -> the reference's raw (all-STRING) inputs, with injected faults.

The mapping is FIXTURES.md section 4.  Everything is a DataFrame over the
given parquet tables, so the work grows with them.  Numbers pass through
DECIMAL before STRING so every engine prints them the same way.

Each raw view carries ``_rid``: a row id that is stable across recomputation.
The orders feed uses (hash of file path, row index in the file) from the
parquet scan; dimension views use their unique data key (its copy is told
apart by a sign), the budget feed ``monotonically_increasing_id`` over its scans.  Dedup uses it only to break ties
between rows that are equal in every output column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.dq import file_row_id
from tallyhouse.operators.views import broadcast_if_small

RID = "_rid"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def _mdy(ts: Column) -> Column:
    """month/day/year text without zero padding."""
    return F.concat_ws("/", _s(F.month(ts)), _s(F.dayofmonth(ts)), _s(F.year(ts)))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x supplier as the orders feed (17 text columns + RunMonth)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    ).withColumn(RID, file_row_id())  # deterministic: (file, row index)
    # lines and orders both grow with the data: a sort-merge join, whatever the
    # size at hand (never a broadcast of the orders)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").hint("merge")
    su = broadcast_if_small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(su, li.l_suppkey == su.s_suppkey)

    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    q = _dec(F.col("l_quantity"), 9, 0)
    p = _dec(F.col("l_extendedprice"), 18, 2)
    d = _dec(F.col("l_discount"), 4, 2)
    lt = _dec(q * p * (F.lit(1) - d), 18, 4)
    ta = _dec(lt * _dec(F.col("l_tax"), 4, 2), 18, 2)

    def fault(mod: int) -> Column:
        return (k % mod) == 0

    return j.select(
        F.when(fault(211), "bad").otherwise(_s(F.col("l_orderkey"))).alias("SalesOrderID"),
        _s(F.col("l_linenumber")).alias("SalesOrderDetailID"),
        F.when(fault(223), "13/45/2011").otherwise(_mdy(F.col("o_orderdate"))).alias("OrderDate"),
        _mdy(F.col("l_shipdate")).alias("DueDate"),
        _mdy(F.col("l_shipdate")).alias("ShipDate"),
        _s(F.col("s_nationkey")).alias("EmployeeID"),
        _s(F.col("o_custkey")).alias("CustomerID"),
        _s(lt).alias("SubTotal"),
        _s(ta).alias("TaxAmt"),
        F.when(fault(241), "-1").otherwise("10.00").alias("Freight"),
        F.when(fault(257), "0").otherwise(_s(_dec(lt + ta + F.lit(10), 18, 4))).alias("TotalDue"),
        _s(F.col("l_partkey")).alias("ProductID"),
        F.when(fault(227), "0").when(fault(229), "").otherwise(_s(q)).alias("OrderQty"),
        F.when(fault(233), F.concat(F.lit("-"), _s(p))).otherwise(_s(p)).alias("UnitPrice"),
        F.when(fault(239), "1.5").otherwise(_s(d)).alias("UnitPriceDiscount"),
        F.when(fault(251), _s(_dec(lt + F.lit(1), 18, 4))).otherwise(_s(lt)).alias("LineTotal"),
        _s(F.col("l_suppkey")).alias("StoreID"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM").alias("RunMonth"),
        F.col(RID),
    )


def _with_dups(base: DataFrame, is_dup: Column, suffix_cols: list[str]) -> DataFrame:
    """UNION ALL the rows selected by ``is_dup`` again, with ' B' appended to the
    named columns.  The row id is the data key ``_k``, negative for a copy, so it
    is the same in every plan branch."""
    dup = base.where(is_dup).select(
        *[(F.concat(F.col(c), F.lit(" B")) if c in suffix_cols else F.col(c)).alias(c)
          for c in base.columns])
    return (base.withColumn(RID, F.col("_k").cast("bigint"))
            .unionByName(dup.withColumn(RID, -F.col("_k").cast("bigint") - 1)))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    base = c.select(
        F.when(key % 97 == 0, F.concat(F.lit("x"), _s(key))).otherwise(_s(key)).alias("CustomerID"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name")).alias("FullName"),
        key.alias("_k"),
    )
    return _with_dups(base, F.col("_k") % 89 == 0, ["LastName", "FullName"]).drop("_k")


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    key = F.col("n_nationkey")
    marital = (F.when(key % 5 == 0, "single").when(key % 5 == 1, "CASADO").when(key % 5 == 2, " s ")
               .when(key % 5 == 3, "Soltera").when(key % 10 == 9, "?").otherwise("M"))
    gender = (F.when(key % 7 == 0, "m").when(key % 7 == 1, "Female").when(key % 7 == 2, "H")
              .when(key % 7 == 3, "mujer").when(key % 7 == 4, " F ").when(key % 7 == 5, "MALE")
              .otherwise("hombre"))
    base = j.select(
        _s(key).alias("EmployeeID"),
        F.when(key % 8 == 0, "").otherwise(_s(F.col("n_regionkey"))).alias("ManagerID"),
        F.col("n_name").alias("FirstName"),
        F.col("r_name").alias("LastName"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" "), F.col("r_name")).alias("FullName"),
        F.lit("Sales Representative").alias("JobTitle"),
        _s(F.col("n_regionkey")).alias("OrganizationLevel"),
        marital.alias("MaritalStatus"),
        gender.alias("Gender"),
        F.col("r_name").alias("Territory"),
        F.col("n_name").alias("Country"),
        F.col("r_name").alias("GroupCol"),
        key.alias("_k"),
    )
    return _with_dups(base, F.col("_k") % 6 == 0, ["FullName"]).drop("_k")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    base = s.select(
        _s(key).alias("StoreID"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("StoreName"),
        F.when(key % 23 == 0, "n/a").otherwise(_s(F.col("s_nationkey"))).alias("EmployeeID"),
        key.alias("_k"),
    )
    return _with_dups(base, F.col("_k") % 29 == 0, ["StoreName"]).drop("_k")


def raw_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    first = s.where(key % 13 != 0).select(
        _s(key).alias("StoreID"),
        F.when(key % 17 == 0, "n/a").otherwise(_s(_dec(F.col("s_acctbal"), 18, 2))).alias("Budget"),
    )
    second = s.where(key % 19 == 1).select(_s(key).alias("StoreID"), F.lit("1.00").alias("Budget"))
    return first.unionByName(second).withColumn(RID, F.monotonically_increasing_id())


def raw_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget sheet text in the shapes the money normaliser must handle."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    k = _s(key)
    m = key % 8
    text = (F.when(m == 0, F.concat(F.lit("$"), k, F.lit(".749.820.000")))
            .when(m == 1, F.concat(F.lit("60."), F.lpad(_s(key % 1000), 3, "0"), F.lit(".820,50")))
            .when(m == 2, F.concat(F.lit("1,234."), F.lpad(_s(key % 100), 2, "0")))
            .when(m == 3, F.concat(F.lit(" "), k, F.lit(" 749 820 ")))
            .when(m == 4, F.concat(k, F.lit(",5")))
            .when(m == 5, F.concat(F.lit("-"), k, F.lit(".25")))
            .when(m == 6, F.lit("n/a"))
            .otherwise(F.lit("")))
    return s.select(k.alias("StoreID"), text.alias("Budget"), key.alias(RID))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    price = _dec(F.col("p_retailprice"), 18, 2)
    base = p.select(
        F.when(key % 103 == 0, "").otherwise(_s(key)).alias("ProductID"),
        F.col("p_brand").alias("ProductNumber"),
        F.concat(F.lit(" "), F.col("p_name")).alias("ProductName"),
        F.when(key % 5 == 0, "   ").otherwise(F.col("p_type")).alias("ModelName"),
        F.when(key % 4 == 0, "1").when(key % 4 == 1, "y").when(key % 4 == 2, "True")
        .otherwise("0").alias("MakeFlag"),
        _s(_dec(price * F.lit(0.6).cast("decimal(2,1)"), 18, 2)).alias("StandardCost"),
        _s(price).alias("ListPrice"),
        F.when(key % 101 == 0, "x").otherwise(_s(F.col("p_size"))).alias("SubCategoryID"),
        key.alias("_k"),
    )
    return _with_dups(base, F.col("_k") % 83 == 0, ["ProductName"]).drop("_k")


def raw_subcategories(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_size").distinct()
    size = F.col("p_size")
    return sizes.select(
        F.when(size == 50, "x").otherwise(_s(size)).alias("SubCategoryID"),
        F.when(size % 11 == 0, "").otherwise(_s(size % 5)).alias("CategoryID"),
        F.concat(F.lit("Sub "), _s(size)).alias("SubCategoryName"),
        size.cast("long").alias(RID),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = table(spark, sf_dir, "part").select((F.col("p_size") % 5).alias("c")).distinct()
    base = cats.select(
        _s(F.col("c")).alias("CategoryID"),
        F.concat(F.lit(" Cat "), _s(F.col("c"))).alias("CategoryName"),
        F.col("c").cast("long").alias(RID),
    )
    extra = cats.groupBy().agg(F.count("*").alias("n")).select(
        F.explode(F.array(
            F.struct(F.lit("1").alias("CategoryID"), F.lit("Cat 1 B").alias("CategoryName"),
                     F.lit(-1).cast("long").alias(RID)),
            F.struct(F.lit("x").alias("CategoryID"), F.lit("Cat x").alias("CategoryName"),
                     F.lit(-2).cast("long").alias(RID)),
        )).alias("r")).select("r.*")
    return base.unionByName(extra)


RAW = {
    "raw_orders": raw_orders,
    "raw_customers": raw_customers,
    "raw_employees": raw_employees,
    "raw_stores": raw_stores,
    "raw_budgets": raw_budgets,
    "raw_money": raw_money,
    "raw_products": raw_products,
    "raw_subcategories": raw_subcategories,
    "raw_categories": raw_categories,
}
