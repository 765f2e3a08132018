"""Monthly load control as DataFrame plans.

The reference runs these as scalar SQL round trips and key-value scans from
a driver loop; here each is one declarative query whose inputs are the data
itself (months present in the feed, months already loaded, status rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X

ORDERS_PREFIX = "bronze/source=github/table=orders/"   # fixed value


def month_load_protocol(incoming: DataFrame, loaded: DataFrame, month: str = "RunMonth") -> DataFrame:
    """I3 per month of a feed: already loaded -> SKIPPED_EXISTS, else SUCCEEDED
    with the inserted row count.  A month is here because it has rows; empty
    files are the load jobs' matter (SKIPPED_EMPTY_FILE)."""
    inc = incoming.groupBy(month).agg(F.count(F.lit(1)).alias("rows_file"))
    have = loaded.groupBy(month).agg(F.count(F.lit(1)).alias("rows_existing"))
    j = inc.join(have, on=month, how="left").withColumn(
        "rows_existing", F.coalesce(F.col("rows_existing"), F.lit(0).cast("bigint")))
    status = F.when(F.col("rows_existing") > 0, "SKIPPED_EXISTS").otherwise("SUCCEEDED")
    return j.select(month, status.alias("status"), "rows_existing",
                    F.when(status == "SUCCEEDED", F.col("rows_file"))
                    .otherwise(F.lit(0).cast("bigint")).alias("rows_inserted"))


def new_month_rows(incoming: DataFrame, loaded: DataFrame, month: str = "RunMonth") -> DataFrame:
    """Incoming rows of months not loaded yet (insert-if-absent)."""
    return incoming.join(loaded.select(month).distinct(), on=month, how="left_anti")


def control_rows(raw_orders: DataFrame, month: str = "RunMonth") -> DataFrame:
    """One control-log record per month written (records_out = rows)."""
    return raw_orders.groupBy(F.col(month).alias("run_month")).agg(
        F.count(F.lit(1)).alias("records_out")).select(
        "run_month", F.lit("github").alias("source"), F.lit("orders").alias("table"),
        F.lit("SUCCEEDED").alias("status"), "records_out")


def control_log_summary(raw_orders: DataFrame) -> DataFrame:
    """Control log rolled up per table, status and year."""
    c = control_rows(raw_orders)
    return c.groupBy("table", "status", F.substring("run_month", 1, 4).alias("year")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.sum("records_out").alias("records_out"),
        F.min("run_month").alias("first_month"), F.max("run_month").alias("last_month"))


def next_run_month(status_rows: DataFrame, start: str, end: str,
                   group: str | None = None, table: str = "orders") -> DataFrame:
    """Last SUCCEEDED month + 1 (or ``start``); past ``end`` -> NO_ACTION."""
    X.check_run_month(start)
    X.check_run_month(end)
    ok = (F.col("table") == table) & (F.col("status") == "SUCCEEDED")
    g = status_rows.groupBy(group) if group else status_rows.groupBy()
    last = g.agg(F.max(F.when(ok, F.col("run_month"))).alias("last_succeeded"))
    cand = F.coalesce(X.next_month("last_succeeded"), F.lit(start))
    return last.select(*([group] if group else []), "last_succeeded", cand.alias("candidate"),
                       F.when(cand <= F.lit(end), "INVOKED").otherwise("NO_ACTION").alias("status"))


def next_run_month_scenarios(raw_orders: DataFrame, loaded_until: str, start: str,
                             end: str) -> DataFrame:
    """Status rows derived per month of the feed, in three control-log states:
    partly loaded, fully loaded, nothing succeeded."""
    months = raw_orders.select(F.col("RunMonth").alias("run_month")).distinct()
    rows = months.select("run_month", F.explode(F.array(
        F.struct(F.lit("partial").alias("scenario"),
                 F.when(F.col("run_month") <= loaded_until, "SUCCEEDED")
                 .otherwise("SKIPPED_EXISTS").alias("status")),
        F.struct(F.lit("complete").alias("scenario"), F.lit("SUCCEEDED").alias("status")),
        F.struct(F.lit("none").alias("scenario"), F.lit("ERROR").alias("status")),
    )).alias("s")).select("run_month", "s.scenario", "s.status", F.lit("orders").alias("table"))
    return next_run_month(rows, start, end, group="scenario")


def landing_keys(orders: DataFrame, bucket: str) -> DataFrame:
    """Object-store events derived from the orders table: one (bucket, key) per
    order, in every shape the key classifier distinguishes."""
    ym = F.date_format("o_orderdate", "yyyy-MM")
    k = F.col("o_orderkey") % 8
    std = F.concat(F.lit(ORDERS_PREFIX + "orders_"), ym, F.lit(".csv"))
    key = (F.when(k == 1, F.concat(F.lit("landing/source=github/table=orders/orders_"), ym, F.lit(".csv")))
           .when(k == 2, F.concat(F.lit("bronze/source=github/table=customers/customers_"), ym, F.lit(".csv")))
           .when(k == 3, F.concat(F.lit(ORDERS_PREFIX + "orders_"), ym, F.lit(".parquet")))
           .when(k == 4, F.concat(F.lit(ORDERS_PREFIX + "orders_"), F.regexp_replace(ym, "-", ""),
                                  F.lit(".csv")))
           .when(k == 5, F.concat(F.lit(ORDERS_PREFIX + "part/orders_"), ym, F.lit(".csv")))
           .otherwise(std))
    b = F.when(k == 0, F.lit("other-bucket")).otherwise(F.lit(bucket))
    return orders.select(b.alias("bucket"), key.alias("key"))


def scalar_int(df: DataFrame, default: int = 0) -> int:
    """A5: the first cell of a one-value query as int; ``default`` when there is
    no row, the value is NULL or it does not parse."""
    row = df.limit(1).collect()
    if not row or row[0][0] is None:
        return default
    try:
        return int(float(row[0][0]))
    except (TypeError, ValueError):
        return default
