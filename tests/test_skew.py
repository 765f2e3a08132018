"""Hot keys: a third of the fact on one key (and a NULL-key group) must not
end up in one task.  AQE splits skewed partitions of the left outer star join
(fact on the left), and the dedup aggregate pre-aggregates map-side."""

import contextlib

from pyspark.sql import functions as F

from tallyhouse.operators import dq
from tallyhouse.operators import views as V

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _fact(spark, n=30000):
    ids = spark.range(n)
    ck = (F.when(F.col("id") % 3 == 0, F.lit(1))
          .when(F.col("id") % 97 == 0, F.lit(None).cast("int"))
          .otherwise((F.col("id") % 500).cast("int")))
    return ids.select(
        F.col("id").cast("int").alias("SalesOrderKey"), F.lit(1).alias("SalesOrderDetailKey"),
        F.current_date().alias("OrderDate"), F.lit("2011-05").alias("RunMonth"),
        ck.alias("CustomerKey"), (F.col("id") % 25).cast("int").alias("EmployeeKey"),
        (F.col("id") % 100).cast("int").alias("StoreKey"), (F.col("id") % 200).cast("int").alias("ProductKey"),
        F.lit(1).alias("OrderQty"), *[F.lit(1.0).alias(c) for c in
                                      ("UnitPrice", "UnitPriceDiscount", "SubTotal", "TaxAmt", "Freight",
                                       "TotalDue", "LineTotal")])


def test_star_join_splits_hot_key(spark):
    with conf(spark, SKEW_CONF):
        fact = _fact(spark)
        cu = spark.range(500).select(F.col("id").cast("int").alias("CustomerKey"),
                                     F.concat(F.lit("c"), F.col("id")).alias("FullName"))
        em = spark.range(25).select(F.col("id").cast("int").alias("EmployeeKey"), F.lit("e").alias("FullName"),
                                    F.lit("t").alias("JobTitle"), F.lit("x").alias("Territory"),
                                    F.lit("y").alias("Country"))
        st = spark.range(100).select(F.col("id").cast("int").alias("StoreKey"))
        pr = spark.range(200).select(F.col("id").cast("int").alias("ProductKey"), F.lit("p").alias("ProductName"),
                                     F.lit("m").alias("ModelName"), F.lit("s").alias("SubCategoryName"),
                                     F.lit("c").alias("CategoryName"))
        v = V.v_sales(fact, cu, em, st, pr)
        rows = v.collect()
        plan = v._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000
    want = sum(1 for i in range(30000) if i % 3 == 0 or (i % 97 != 0 and i % 500 == 1))
    assert sum(1 for r in rows if r["CustomerName"] == "c1") == want
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_dedup_hot_key_is_spread(spark):
    with conf(spark, SKEW_CONF | {"spark.sql.shuffle.partitions": "64"}):
        df = spark.range(64000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-7).alias("k"),
                                       (F.col("id") % 10).alias("v"), F.col("id").alias(dq.RID))
        out = dq.mark_first(df, ["k"], [("v", "desc")])
        firsts = out.where(F.col(dq.FIRST) & (F.col("k") == -7)).collect()
        spread = out.groupBy(F.spark_partition_id()).agg(F.count(F.when(F.col("k") == -7, 1)).alias("n"),
                                                            F.max(dq.FIRST)).collect()
    assert len(firsts) == 1 and firsts[0]["v"] == 9
    # two thirds of the rows have one key; no task holds more than a tenth of them
    hot = sum(r["n"] for r in spread)
    assert hot > 42000 and max(r["n"] for r in spread) < hot / 10


def test_first_rows_are_pre_aggregated(spark):
    df = spark.range(20000).select(F.lit(7).alias("k"), (F.col("id") % 10).alias("v"), F.col("id").alias(dq.RID))
    out = dq.keep_first(df, ["k"], [("v", "desc")])
    assert [r["v"] for r in out.collect()] == [9]
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_store_join_dropped_only_when_keys_unique(spark):
    fact = _fact(spark, 3000)
    cu = spark.range(500).select(F.col("id").cast("int").alias("CustomerKey"), F.lit("c").alias("FullName"))
    em = spark.range(25).select(F.col("id").cast("int").alias("EmployeeKey"), F.lit("e").alias("FullName"),
                                F.lit("t").alias("JobTitle"), F.lit("x").alias("Territory"),
                                F.lit("y").alias("Country"))
    pr = spark.range(200).select(F.col("id").cast("int").alias("ProductKey"), F.lit("p").alias("ProductName"),
                                 F.lit("m").alias("ModelName"), F.lit("s").alias("SubCategoryName"),
                                 F.lit("c").alias("CategoryName"))
    st = spark.range(100).select(F.col("id").cast("int").alias("StoreKey"))
    full = V.v_sales(fact, cu, em, st, pr)
    short = V.v_sales(fact, cu, em, st, pr, store_keys_unique=True)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, short.collect()))
    dup = st.unionByName(st.where("StoreKey = 1"))
    assert V.v_sales(fact, cu, em, dup, pr).count() > 3000      # duplicates fan out


def test_small_dimensions_shuffle_no_fact(spark, monkeypatch):
    """Employees and store keys that are queries of their own are counted and
    broadcast; the joins that shuffle the fact come before their texts are on it."""
    fact = _fact(spark, 3000)
    cu = spark.range(500).select(F.col("id").cast("int").alias("CustomerKey"), F.lit("c").alias("FullName"))
    em = spark.range(25).select(F.col("id").cast("int").alias("EmployeeKey"), F.lit("e").alias("FullName"),
                                F.lit("t").alias("JobTitle"), F.lit("x").alias("Territory"),
                                F.lit("y").alias("Country"))
    pr = spark.range(200).select(F.col("id").cast("int").alias("ProductKey"), F.lit("p").alias("ProductName"),
                                 F.lit("m").alias("ModelName"), F.lit("s").alias("SubCategoryName"),
                                 F.lit("c").alias("CategoryName"))
    st = spark.range(100).unionByName(spark.range(5)).select(F.col("id").cast("int").alias("StoreKey"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plans = [V.v_sales(fact, cu, em, st, pr, counted=c) for c in (False, True)]
        shown = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
        rows = [sorted(map(str, p.collect())) for p in plans]
        monkeypatch.setattr(V, "SMALL_VALUES", 99)
        large = V.broadcast_if_small(st)._jdf.queryExecution().optimizedPlan().toString()
        few = V.broadcast_if_small(st.where("StoreKey < 50"))
        assert "broadcast" in few._jdf.queryExecution().analyzed().toString()
    assert rows[0] == rows[1] and len(rows[0]) > 3000
    assert "broadcast" not in large
    assert [t.count("SortMergeJoin") for t in shown] == [4, 2] and shown[1].count("BroadcastHashJoin") == 2
    for t in shown:
        wide = [t.index(f"[{k}") for k in ("StoreKey#", "EmployeeKey#", "ProductKey#", "CustomerKey#")]
        assert wide == sorted(wide)         # the plan's last join stands first


def test_feed_join_never_broadcasts_the_orders(spark):
    from conftest import SF_SMALL
    from tallyhouse.sources import fixtures as FX
    df = FX.raw_orders(spark, SF_SMALL)
    df.count()
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan
