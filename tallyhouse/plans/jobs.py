"""Batch jobs over a lake folder: ingest (I5), bronze -> silver (I7),
warehouse build (K3/K4, L1-L5), one-month fact load (I3/I4), next month (I6).

Ingest writes bronze month slices and, once a slice is complete, its arrival
marker; silver reads bronze; the fact load reads silver (or bronze) slices, and
the file-arrival stream loads what the markers announce.  Status, error code
and manifest table names are fixed values.

Each job is a few Spark actions over whole datasets; the driver only sees
counts and per-month status records (control plane).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import exprs as X
from tallyhouse.operators import clean as C
from tallyhouse.operators import dq
from tallyhouse.operators import rollups as R
from tallyhouse.operators import warehouse as W
from tallyhouse.plans import loads as L
from tallyhouse.sinks import claims, snapshots
from tallyhouse.sinks import writers as K
from tallyhouse.sources import bronze as B
from tallyhouse.sources import external as E
from tallyhouse.sources import files


@dataclass(frozen=True)
class Lake:
    """Folder layout of one lake (any Hadoop-compatible URI)."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_orders(self) -> str:           # year=Y/month=M partitions
        return self._p("bronze", "source=github", "table=orders")

    @property
    def landing_orders(self) -> str:          # orders_YYYY-MM.csv files, .ready markers (file-arrival)
        return self._p("landing", "source=github", "table=orders")

    def ready_marker(self, run_month: str) -> str:
        return f"{self.landing_orders}/orders_{run_month}.ready"

    @property
    def budget_inbox(self) -> str:
        return self._p("bronze", "source=excel", "table=storesBudget", "inbox")

    def bronze_dim(self, table: str) -> str:  # run_month=YYYY-MM snapshots
        return self._p("bronze", f"table={table}")

    @property
    def silver_orders(self) -> str:
        return self._p("silver", "domain=sales")

    def silver_dim(self, entity: str) -> str:
        return self._p("silver", f"dim={entity}")

    def invalid(self, entity: str) -> str:
        return self._p("logs", "invalid", entity)

    def warehouse(self, table: str) -> str:
        return self._p("warehouse", table)

    def rollup(self, name: str) -> str:
        return self._p("warehouse", f"rollup_{name}")

    @property
    def control(self) -> str:
        return self._p("logs", "control")

    @property
    def errors(self) -> str:
        return self._p("logs", "errors")

    @property
    def load_status(self) -> str:
        return self._p("logs", "fact_load_status")


def _run_id(prefix: str, months: list[str]) -> str:
    return f"{prefix}_{'_'.join(months)}_{int(dt.datetime.now(dt.timezone.utc).timestamp())}"


def _control(spark: SparkSession, lake: Lake) -> DataFrame:
    """The control log; empty before the first record."""
    return K.read_log(spark, lake.control, K.CONTROL_SCHEMA)


def present_months(spark: SparkSession, base: str, months: list[str]) -> set[str]:
    """Which of ``months`` have a complete ``year=Y/month=M`` slice under
    ``base``, with data files or, for a month without rows, the commit marker
    alone: metadata calls for each, never a listing of the table."""
    return {m for m in months for at in [B.month_folder(base, m)]
            if files.has_data(spark, at) or K.is_committed(spark, at)}


def _slice(run_month: str) -> dict:
    y, m = (int(v) for v in run_month.split("-"))
    return {"year": y, "month": m}


# ------------------------------------------------------------------ ingest
LINE = "_line"                      # text of a line with too many or too few fields
MALFORMED = "MALFORMED_LINE"


def _malformed(lines: Observation, rows: DataFrame) -> int:
    """Malformed lines counted while ``rows`` were read.  Where no row was left,
    Spark drops the observation with the plan; then they are counted anew."""
    try:
        return int(lines.get["malformed"])
    except Py4JJavaError:
        # (a query of that column alone is not allowed on CSV)
        return rows.agg(F.count(LINE).alias("n"), F.count(rows.columns[0]).alias("other")).first()["n"]


def _quarantine_lines(rows: DataFrame, path: str, by: list[str], specs: list[dict], n: int) -> None:
    """The malformed lines among ``rows`` (``n`` of them) replace those of the same slices."""
    spark = rows.sparkSession
    if n or files.exists(spark, path):
        bad = rows.where(F.col(LINE).isNotNull()).select(
            F.col(LINE).alias("line"), F.col(rows.columns[0]).alias("first_field"), F.lit(MALFORMED).alias(dq.REASON), *by)
        K.overwrite_slice(bad, path, by, specs)


def ingest_orders(spark: SparkSession, src: str, lake: Lake, run_months: list[str],
                  date_field: str = "OrderDate", date_format: str | None = "MM-dd-yyyy",
                  allow_overwrite: bool = False, multiline: bool = False) -> list[dict]:
    """I5 + P4 + K5-K8: one pass over the delivered orders file for all requested
    months; rows land in ``year=/month=`` partitions (dynamic overwrite).
    Months whose slice is there are SKIPPED_EXISTS unless ``allow_overwrite``;
    a slice that was lost or removed is written again, whatever the log says.
    Lines with too many or too few fields go to ``invalid("ingest_orders_lines")``
    with REASON MALFORMED_LINE: by the month of their date, or ``unknown``."""
    for m in run_months:
        X.check_run_month(m)
    run_id = _run_id("csv", run_months)
    snapshots.recover(spark, lake.bronze_orders)
    existing = present_months(spark, lake.bronze_orders, run_months)
    todo = [m for m in run_months if allow_overwrite or m not in existing]
    folder = {m: B.month_folder(lake.bronze_orders, m) for m in run_months}
    results = [{"table": "orders", "run_month": m, "status": "SKIPPED_EXISTS", "rows": 0,
                "note": f"{folder[m]} already exists"} for m in run_months if m not in todo]
    if todo:
        raw = B.read_delivery(spark, src, multiline, LINE).withColumn("_ym", X.parsed_month(date_field, date_format))
        lines = Observation("lines")
        staged = (raw.observe(lines, F.count(LINE).alias("malformed"))
                  .where(F.col(LINE).isNull() & F.col("_ym").isin(todo)).drop(LINE)
                  .withColumn("year", F.substring("_ym", 1, 4).cast("int"))
                  .withColumn("month", F.substring("_ym", 6, 2).cast("int")).drop("_ym"))
        counts = K.overwrite_slice(staged, lake.bronze_orders, ["year", "month"], [_slice(m) for m in todo],
                                   fmt="csv", header=True, escape='"')
        _quarantine_lines(raw.withColumn("run_month", F.coalesce("_ym", F.lit("unknown"))),
                          lake.invalid("ingest_orders_lines"), ["run_month"],
                          [{"run_month": m} for m in [*todo, "unknown"]], _malformed(lines, raw))
        for m in todo:                        # the slice is complete: announce it
            files.put_text(spark, lake.ready_marker(m), folder[m] + "\n")
        results += [{"table": "orders", "run_month": m, "status": "SUCCEEDED", "rows": n, "note": f"wrote {folder[m]}"}
                    for m, n in zip(todo, counts)]
    K.log_control(spark, lake.control, [
        {"run_id": f"{run_id}#orders", "run_month": r["run_month"], "source": "github",
         "table": "orders", "status": r["status"], "records_out": r["rows"], "note": r["note"]} for r in results])
    return results


def _land_snapshot(spark: SparkSession, df: DataFrame, table: str, lake: Lake, run_month: str, source: str,
                   allow_overwrite: bool, prefix: str) -> dict:
    """A dimension snapshot, written once per run month (K6), with its control row."""
    target = f"{lake.bronze_dim(table)}/run_month={X.check_run_month(run_month)}"
    status, n = K.write_once(df, target, allow_overwrite, "csv", header=True, escape='"')
    K.log_control(spark, lake.control, [{
        "run_id": _run_id(prefix, [run_month]) + f"#{table}", "run_month": run_month, "source": source, "table": table,
        "status": status, "records_out": n,
        "note": f"wrote {target}" if status == "SUCCEEDED" else f"{target} already exists"}])
    return {"table": table, "status": status, "rows": n}


def ingest_dim_snapshot(spark: SparkSession, table: str, src: str, lake: Lake, run_month: str,
                        allow_overwrite: bool = False, multiline: bool = False) -> dict:
    """A delivered CSV of one dimension."""
    return _land_snapshot(spark, B.read_delivery(spark, src, multiline), table, lake, run_month, "github",
                          allow_overwrite, "dims")


def ingest_stores(spark: SparkSession, lake: Lake, run_month: str, url: str, query: str = E.STORES_QUERY,
                  properties: dict | None = None, allow_overwrite: bool = True, **slices) -> dict:
    """The store table of the operational database; ``slices`` split the
    read (see read_jdbc_query).  Each run replaces its month's snapshot."""
    rows = E.read_jdbc_query(spark, url, query.rstrip("; \n"), properties=properties, **slices)
    return _land_snapshot(spark, rows, "stores", lake, run_month, "mysql", allow_overwrite, "stores")


def ingest_budget(spark: SparkSession, lake: Lake, run_month: str, inbox: str | None = None, suffix: str = ".csv",
                  sep: str = ";", allow_overwrite: bool = True) -> dict:
    """S6 + S5: the first budget sheet of the inbox, cleaned."""
    sheet = E.pick_inbox_file(spark, inbox or lake.budget_inbox, suffix)
    return _land_snapshot(spark, E.read_budget_sheet(spark, sheet, sep), "stores_budget", lake, run_month, "excel",
                          allow_overwrite, "budget")


# --------------------------------------------------------- bronze -> silver
DIM_ENTITIES = {
    # entity: (bronze table, cleaner)
    "customer": ("customers", C.clean_customers),
    "employee": ("employees", C.clean_employees),
    "productCategory": ("product_categories", C.clean_categories),
    "productSubcategory": ("product_subcategories", C.clean_subcategories),
    "product": ("products", C.clean_products),
}


def bronze_to_silver(spark: SparkSession, lake: Lake, run_month: str, refresh_dims: bool = False,
                     null_policy: str = "parity") -> dict:
    """Orders of ``run_month`` always; dimension snapshots when asked.  Each
    output replaces exactly its own slice, also when it has no rows.  Lines of a
    bronze file with too many or too few fields (files landed by others) go to
    ``invalid("orders_lines")`` with REASON MALFORMED_LINE."""
    X.check_run_month(run_month)
    out = {}
    snapshots.recover(spark, lake.bronze_orders)
    orders = B.read_month(spark, "orders", lake.bronze_orders, run_month, corrupt_col=LINE)
    lines = Observation("lines")
    good = orders.observe(lines, F.count(LINE).alias("malformed")).where(F.col(LINE).isNull()).drop(LINE)
    out["orders"] = K.write_routed(C.clean_orders(good, null_policy), lake.silver_orders, lake.invalid("orders"),
                                   _slice(run_month))
    n = _malformed(lines, orders)
    _quarantine_lines(orders, lake.invalid("orders_lines"), ["year", "month"], [_slice(run_month)], n)
    if n:
        out["orders_lines"] = {"malformed": n}
    if refresh_dims:
        snap = {"run_month": run_month}
        for entity, (table, cleaner) in DIM_ENTITIES.items():
            raw = B.read_bronze(spark, table, f"{lake.bronze_dim(table)}/run_month={run_month}")
            out[entity] = K.write_routed(cleaner(raw), lake.silver_dim(entity),
                                         lake.invalid(f"dim={entity}"), snap)
        stores = B.read_bronze(spark, "stores", f"{lake.bronze_dim('stores')}/run_month={run_month}")
        budgets = B.read_bronze(spark, "stores_budget",
                                f"{lake.bronze_dim('stores_budget')}/run_month={run_month}")
        out["store"] = K.write_routed(C.clean_stores(stores, budgets), lake.silver_dim("store"),
                                      lake.invalid("dim=store"), snap)
    return out


def read_silver_dim(spark: SparkSession, lake: Lake, entity: str, run_month: str) -> DataFrame:
    snapshots.recover(spark, lake.silver_dim(entity))
    return spark.read.parquet(K.slice_path(lake.silver_dim(entity), {"run_month": run_month}))


# ---------------------------------------------------------------- warehouse
def build_dims(spark: SparkSession, lake: Lake, run_month: str, source: str = "silver",
               mode: str = "overwrite") -> dict:
    """SCD1 dimension refresh (``mode='overwrite'``, the default) from silver or
    bronze; ``mode='append'`` is the reference's INSERT INTO (K3), where every
    rerun adds the rows again.  Returns the number of duplicated keys per
    dimension."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    if source == "silver":
        cu = read_silver_dim(spark, lake, "customer", run_month).withColumnRenamed("CustomerID", "CustomerKey")
        em = (read_silver_dim(spark, lake, "employee", run_month)
              .withColumnRenamed("EmployeeID", "EmployeeKey").withColumnRenamed("Group", "GroupCol"))
        st = read_silver_dim(spark, lake, "store", run_month).withColumnRenamed("StoreID", "StoreKey")
        p = read_silver_dim(spark, lake, "product", run_month)
        s = read_silver_dim(spark, lake, "productSubcategory", run_month)
        c = read_silver_dim(spark, lake, "productCategory", run_month)
        pr = (p.join(s.select("SubCategoryID", "CategoryID", "SubCategoryName"), "SubCategoryID", "left")
              .join(c, "CategoryID", "left")
              .select(F.col("ProductID").alias("ProductKey"), "ProductNumber", "ProductName", "ModelName",
                      F.col("MakeFlag").cast("int").alias("MakeFlag"), "StandardCost", "ListPrice",
                      "SubCategoryID", "SubCategoryName", "CategoryID", "CategoryName"))
    elif source == "bronze":
        snap = {t: B.read_bronze(spark, t, f"{lake.bronze_dim(t)}/run_month={run_month}", row_id=False)
                for t in ("customers", "employees", "stores", "stores_budget", "products",
                          "product_subcategories", "product_categories")}
        cu = W.dim_customer_load(snap["customers"])
        em = W.dim_employee_load(snap["employees"])
        st = W.dim_store_load(snap["stores"], snap["stores_budget"])
        pr = W.dim_product_flatten(snap["products"], snap["product_subcategories"],
                                   snap["product_categories"])
    else:
        raise ValueError("source must be 'silver' or 'bronze'")
    keys = {"dim_customer": "CustomerKey", "dim_employee": "EmployeeKey", "dim_store": "StoreKey",
            "dim_product": "ProductKey"}
    dup = {}
    for name, df in (("dim_customer", cu), ("dim_employee", em), ("dim_store", st), ("dim_product", pr)):
        df = W.to_warehouse(df, name)
        if mode == "append":
            K.append_table(df, lake.warehouse(name))
        else:
            K.write_parquet(df, lake.warehouse(name))
        # unique-key report on what was written: duplicates fan out v_sales lines
        dup[name] = dq.duplicate_keys(W.read_warehouse(spark, lake.warehouse(name), name), [keys[name]]).count()
    return dup


def load_month(spark: SparkSession, lake: Lake, run_month: str | None = None, key: str | None = None,
               bucket: str | None = None, expected_bucket: str | None = None, source: str = "silver",
               insert: str = "overwrite", catalog: str | None = None) -> dict:
    """Load one month into fact_sales if the month is absent.

    ``run_month`` reads what the jobs before wrote: the validated silver slice,
    or with ``source="bronze"`` the raw one (no DQ, no dedup; the reference's
    path).  ``key`` names one landed month file and wins; neither ->
    IGNORED_NO_INPUT.  The insert overwrites exactly that RunMonth partition, so
    a replay after a failure cannot duplicate rows; ``insert="append"`` is the
    reference's INSERT INTO.  A claim on the month keeps two loaders (jobs or
    streams, in any driver) from loading it both: the second is SKIPPED_EXISTS.
    The month's partial sums are refreshed after it, and with ``catalog`` (a
    database that ``register_tables`` filled) its partition is added there.  A failure is reported as status ERROR instead of
    stopping the caller.
    """
    try:
        out = _load_month(spark, lake, run_month, key, bucket, expected_bucket, source, insert)
        if out["status"] == "SUCCEEDED":
            refresh_rollups(spark, lake, [out["run_month"]])
            if catalog:
                spec = {"RunMonth": out["run_month"]}
                K.add_partition(spark, f"{catalog}.fact_sales", spec, K.slice_path(lake.warehouse("fact_sales"), spec))
        return out
    except Exception as e:  # one bad month must not stop the others
        return {"key": key or run_month, "status": "ERROR", "error": str(e)}


def _load_month(spark, lake, run_month, key, bucket, expected_bucket, source, insert) -> dict:
    if key is None and run_month is None:
        return {"results": [], "status": "IGNORED_NO_INPUT"}
    if source not in ("silver", "bronze") or insert not in ("overwrite", "append"):
        raise ValueError("source must be 'silver' or 'bronze', insert 'overwrite' or 'append'")
    if key is not None:
        root = lake.root.rstrip("/") + "/"
        exp = expected_bucket or "lake"
        probe = spark.range(1).select(X.decode_key(F.lit(key)).alias("key")).withColumn(
            "rel", F.when(F.col("key").startswith(root), F.substr("key", F.lit(len(root) + 1))).otherwise(F.col("key"))
        ).select("key", X.classify_key(F.lit(bucket or exp), "rel", exp, prefix="landing/source").alias("s"),
                 X.month_from_key("rel").alias("m")).first()
        if probe["s"] != "ACCEPTED":
            return {"key": key, "status": probe["s"]}
        key, ym = probe["key"], probe["m"]
    else:
        ym = X.check_run_month(run_month)
        key = K.slice_path(lake.silver_orders, _slice(ym)) if source == "silver" else \
            B.month_folder(lake.bronze_orders, ym)
    path = lake.warehouse("fact_sales")
    with claims.held(spark, claims.month_folder(path, ym), f"load-{uuid.uuid4().hex}") as claim:
        # counted under the claim: nobody else loads this month between the count and the insert
        n_month = _count_month(spark, lake, ym)
        if n_month > 0:
            return {"key": key, "run_month": ym, "status": "SKIPPED_EXISTS", "rows_existing": n_month}
        if claim is None:
            return {"key": key, "run_month": ym, "status": "SKIPPED_EXISTS", "rows_existing": 0,
                    "note": "another loader is at work on this month"}
        if run_month is None or key.endswith(".csv"):
            fact = W.fact_projection(B.read_bronze(spark, "orders", key, row_id=False), ym)
        elif source == "silver":
            snapshots.recover(spark, lake.silver_orders)
            fact = W.fact_from_silver(spark.read.parquet(key), ym)
        else:
            snapshots.recover(spark, lake.bronze_orders)
            fact = W.fact_projection(B.read_month(spark, "orders", lake.bronze_orders, ym, row_id=False), ym)
        if fact.isEmpty():
            return {"key": key, "run_month": ym, "status": "SKIPPED_EMPTY_FILE", "rows_file": 0}
        if insert == "append":
            K.append_table(fact, path, ["RunMonth"])
        else:
            K.overwrite_slice(fact, path, ["RunMonth"], [{"RunMonth": ym}])
        # what the table holds now, not what the writer said
        return {"key": key, "run_month": ym, "status": "SUCCEEDED", "rows_inserted": _count_month(spark, lake, ym)}


def _count_month(spark: SparkSession, lake: Lake, ym: str) -> int:
    """Rows of one RunMonth partition: its folder alone is read (footers)."""
    folder = K.slice_path(lake.warehouse("fact_sales"), {"RunMonth": ym})
    if not files.has_data(spark, folder):
        return 0
    return L.scalar_int(spark.read.parquet(folder).agg(F.count(F.lit(1))))


def refresh_rollups(spark: SparkSession, lake: Lake, run_months: list[str] | None = None) -> list[str]:
    """Write the partial sums of the given months, each in place of its old
    ones; without any given, of the months whose fact slice is newer than its
    partials (a rerun, a backfill, a stream's load, a job that died between the
    two).  Returns the months written."""
    fact_path = lake.warehouse("fact_sales")
    if run_months is None:
        last = R.TABLES[-1]                   # written last, so it stands for all
        run_months = [m for s in files.partitions(spark, fact_path, ["RunMonth"]) for m in [s["RunMonth"]]
                      if files.newest(spark, K.slice_path(fact_path, s)) >
                      files.newest(spark, K.slice_path(lake.rollup(last), s))]
    if not run_months:
        return []
    specs = [{"RunMonth": m} for m in run_months]
    schema = W.WAREHOUSE_SCHEMAS["fact_sales"]
    fact = spark.read.schema(schema).option("basePath", fact_path).parquet(*[K.slice_path(fact_path, s) for s in specs])
    parts = R.partials(fact)
    for name in R.TABLES:
        K.overwrite_slice(parts[name], lake.rollup(name), ["RunMonth"], specs)
    return run_months


def read_rollups(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The partial tables, for the measures of ``operators.rollups``."""
    for name in R.TABLES:
        snapshots.recover(spark, lake.rollup(name))
    return {name: spark.read.schema(R.SCHEMAS[name]).parquet(lake.rollup(name)) for name in R.TABLES}


def loaded_months(spark: SparkSession, lake: Lake) -> DataFrame:
    """RunMonth of each loaded month, from the names of the fact's partition
    folders (a load never leaves one without rows): no fact file is opened."""
    path = lake.warehouse("fact_sales")
    months = [s["RunMonth"] for s in files.partitions(spark, path, ["RunMonth"])
              if files.has_data(spark, K.slice_path(path, s))]
    return spark.createDataFrame([(m,) for m in months], "RunMonth string")


def register_tables(spark: SparkSession, lake: Lake, database: str) -> list[str]:
    """Catalog tables over the warehouse; the fact by RunMonth.  Months
    loaded later are added one by one by ``load_month(catalog=database)``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, schema in W.WAREHOUSE_SCHEMAS.items():
        if files.exists(spark, lake.warehouse(name)):
            K.register_table(spark, f"{database}.{name}", lake.warehouse(name), schema,
                             partition_cols=["RunMonth"] if name == "fact_sales" else None)
            names.append(name)
    return names


def next_month_job(spark: SparkSession, lake: Lake, start: str = "2011-05",
                   end: str = "2014-05") -> dict:
    """The month the scheduler would request next, from the control log."""
    r = L.next_run_month(_control(spark, lake), start, end).first()
    out = {"status": r["status"], "candidate": r["candidate"], "last_succeeded": r["last_succeeded"]}
    if r["status"] == "NO_ACTION":
        out["reason"] = f"candidate {r['candidate']} > END_MONTH {end}"
    return out


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """The three BI views as temporary views over the warehouse tables."""
    from tallyhouse.operators import views as V
    fact = W.read_warehouse(spark, lake.warehouse("fact_sales"), "fact_sales")
    d = {n: W.read_warehouse(spark, lake.warehouse(n), n)
         for n in ("dim_customer", "dim_employee", "dim_store", "dim_product")}
    # the store join only matters if StoreKey repeats; prove it before dropping it
    unique = dq.duplicate_keys(d["dim_store"], ["StoreKey"]).limit(1).count() == 0
    V.v_sales(fact, d["dim_customer"], d["dim_employee"], d["dim_store"], d["dim_product"],
              store_keys_unique=unique).createOrReplaceTempView("v_sales")
    V.v_dim_store(d["dim_store"]).createOrReplaceTempView("v_dim_store")
    V.v_calendar_month_loaded(loaded_months(spark, lake)).createOrReplaceTempView("v_calendar_month_loaded")
    return ["v_sales", "v_dim_store", "v_calendar_month_loaded"]


# fixed values: manifest table name -> bronze table of this package
MANIFEST_TABLES = {"customers": "customers", "employee": "employees", "orders": "orders",
                   "productCategories": "product_categories", "products": "products",
                   "productSubcategories": "product_subcategories", "stores": "stores",
                   "storesBudget": "stores_budget"}


def ingest_from_manifest(spark: SparkSession, manifest_path: str, lake: Lake, run_months: list[str],
                         refresh_dims: bool = False, allow_overwrite: bool = False,
                         jdbc: dict | None = None, budget: dict | None = None) -> dict:
    """The ingest handler: manifest -> dimension snapshots (once, optional) ->
    orders months.  Each failing step writes an error record (K9) with its
    code and the whole message, and re-raises.

    By source type: ``csv_github`` reads ``url_or_query`` as a Spark-readable
    path; ``mysql`` runs it over JDBC (``jdbc``: url, properties, ...) and
    ``excel`` takes the budget inbox (``budget``: inbox, suffix, sep); a source
    whose connection is not given is left to its own job.
    """
    from tallyhouse.sources import manifest as MF
    run_id = _run_id("csv", run_months)

    def fail(table: str, code: str, e: Exception, source: str = "github"):
        K.log_error(spark, lake.errors, run_id, source, table, "ingest", code, str(e))

    try:
        sources, defaults = MF.load_manifest(spark, manifest_path)
        srcs = [r.asDict() for r in sources.collect()]           # a handful of manifest entries
        allow_overwrite = allow_overwrite or bool((defaults.first() or [False])[0])
    except Exception as e:
        fail("_manifest", "LOAD_MANIFEST", e)
        raise
    out = {"run_id": run_id, "dims": [], "orders": []}
    if refresh_dims:
        month = run_months[0]
        try:
            for s in srcs:
                if s["type"] == "csv_github" and s["table"] != "orders":
                    out["dims"].append(ingest_dim_snapshot(spark, MANIFEST_TABLES[s["table"]], s["url_or_query"],
                                                           lake, month, allow_overwrite))
                elif s["type"] == "mysql" and jdbc:
                    out["dims"].append(ingest_stores(spark, lake, month, query=s["url_or_query"], **jdbc))
                elif s["type"] == "excel" and budget is not None:
                    out["dims"].append(ingest_budget(spark, lake, month, **budget))
        except Exception as e:
            fail("_dims", "DIMS_SNAPSHOT", e)
            raise
    orders = next((s for s in srcs if s["type"] == "csv_github" and s["table"] == "orders"), None)
    if orders is None:
        e = RuntimeError("no 'orders' source in the manifest")
        fail("orders", "ORDERS_SRC_NOT_FOUND", e)
        raise e
    try:
        out["orders"] = ingest_orders(spark, orders["url_or_query"], lake, run_months,
                                      orders.get("date_field") or "OrderDate",
                                      orders.get("date_format") or "MM-dd-yyyy", allow_overwrite)
    except Exception as e:
        fail("orders", "ORDERS_MONTH_INGEST", e)
        raise
    return out
