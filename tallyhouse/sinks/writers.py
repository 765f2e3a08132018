"""Sinks: K1-K11.

Silver and warehouse tables are Parquet (Snappy).  A slice is a partition
folder; rewriting one replaces exactly that folder, also when no row is left
for it, and readers see the old one until the new one is complete
(``snapshots``).  Control and error logs are append-only Parquet tables, a
folder per month, compacted as they grow.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import exprs as X
from tallyhouse.operators.dq import Routed
from tallyhouse.sinks import snapshots
from tallyhouse.sources import files

CONTROL_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("run_month", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("records_out", T.LongType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("ended_at", T.TimestampType()),
    T.StructField("note", T.StringType()),
])
ERROR_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("source", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("step", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("error_code", T.StringType()), T.StructField("message", T.StringType()),
])


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Dynamic overwrite; rows of one partition are gathered first (and a large
    partition is split by AQE), so tasks do not each write a file to each."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def slice_path(path: str, spec: dict | None) -> str:
    return "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in (spec or {}).items())])


def write_silver(df: DataFrame, path: str, spec: dict | None = None) -> None:
    """K1: CTAS-equivalent: Parquet/Snappy at an explicit location, or exactly
    the slice ``spec`` (column -> value) of a partitioned one."""
    base, rel = (path, slice_path("", spec)[1:]) if spec else path.rstrip("/").rsplit("/", 1)

    def write(folder: str) -> list[str]:
        df.write.parquet(f"{folder}/{rel}")
        return [rel]
    snapshots.replace(df.sparkSession, base, write)


def write_quarantine(df: DataFrame, path: str, spec: dict | None = None) -> None:
    """K2: invalid rows with REASON."""
    write_silver(df, path, spec)


def write_routed(routed: Routed, valid_path: str, invalid_path: str, spec: dict | None = None) -> dict:
    """Write both outputs of one routed stage, each over its whole slice, and
    return their counts.  The flagged rows are computed once for both (kept in
    memory and on executors' disks while the slice is written)."""
    r = replace(routed, flagged=routed.flagged.persist(StorageLevel.MEMORY_AND_DISK), firsts=None)
    try:
        ov, oi = Observation("valid"), Observation("invalid")
        write_silver(r.valid().observe(ov, F.count(F.lit(1)).alias("n")), valid_path, spec)
        write_quarantine(r.invalid().observe(oi, F.count(F.lit(1)).alias("n")), invalid_path, spec)
        return {"valid": int(ov.get["n"]), "invalid": int(oi.get["n"])}
    finally:
        r.flagged.unpersist()


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K3/K4: INSERT INTO (append only)."""
    write_parquet(df, path, "append", partition_by)


def overwrite_slice(df: DataFrame, path: str, partition_by: list[str], specs: list[dict] | None = None,
                    fmt: str = "parquet", **options) -> list[int] | None:
    """K7: replace the partitions present in ``df`` (dynamic overwrite).

    With ``specs`` (the slices asked for, column -> value) the rows of each are
    counted while they are written, a slice without rows is emptied, all of them
    change together, and the counts are returned in order."""
    df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if specs is None:
        (df.write.format(fmt).options(**options)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path))
        return None
    mine = [F.coalesce(_in_slice(spec), F.lit(False)) for spec in specs]
    seen = Observation("slices")
    counts = []

    def write(folder: str) -> list[str]:
        # counted in the writing stage itself, where a task's rows count once
        (df.where(reduce(lambda a, b: a | b, mine))
         .observe(seen, *[F.count(F.when(m, 1)).alias(f"n{i}") for i, m in enumerate(mine)])
         .write.format(fmt).options(**options).partitionBy(*partition_by).save(folder))
        counts.extend(int(seen.get[f"n{i}"]) for i in range(len(specs)))
        none = df.drop(*partition_by).limit(0)
        for spec, n in zip(specs, counts):
            if n == 0:
                none.write.format(fmt).options(**options).save(slice_path(folder, spec))
        return [slice_path("", spec)[1:] for spec in specs]
    snapshots.replace(df.sparkSession, path, write)
    return counts


def _in_slice(spec: dict):
    out = F.lit(True)
    for k, v in spec.items():
        out = out & (F.col(k) == F.lit(v))
    return out


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when a write job completed at ``path`` (its ``_SUCCESS`` marker)."""
    return files.exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_once(df: DataFrame, path: str, allow_overwrite: bool = False, fmt: str = "csv",
               **options) -> tuple[str, int]:
    """K6: a committed target without ``allow_overwrite`` -> ('SKIPPED_EXISTS', 0);
    otherwise write and return ('SUCCEEDED', rows written).  A target left
    without its commit marker by a failed job is rewritten, not skipped."""
    def attempt(mode: str) -> int:
        obs = Observation("write_once")
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**options) \
            .mode(mode).save(path)
        return int(obs.get["n"])

    try:
        return "SUCCEEDED", attempt("overwrite" if allow_overwrite else "errorifexists")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    if is_committed(df.sparkSession, path):
        return "SKIPPED_EXISTS", 0
    return "SUCCEEDED", attempt("overwrite")


LOG_FILES = 64           # files of one month of a log beyond which they become one


def _append_log(rows: DataFrame, path: str, when: Column) -> None:
    """Append to the log, a folder ``log_month=YYYY-MM`` for each month of
    ``when``.  A month of many files is rewritten as one and swapped in whole;
    appending and compacting take turns by a claim on the log."""
    from tallyhouse.sinks import claims
    spark = rows.sparkSession
    owner, deadline = uuid.uuid4().hex, time.monotonic() + 300
    while not (claim := claims.acquire(spark, f"{path.rstrip('/')}/_claim", owner, lease=600)):
        if time.monotonic() > deadline:
            raise TimeoutError(f"the log {path} is busy")
        time.sleep(0.2)
    try:
        snapshots.recover(spark, path)
        (rows.withColumn("log_month", F.date_format(when, "yyyy-MM")).coalesce(1)
         .write.mode("append").partitionBy("log_month").parquet(path))
        for spec in files.partitions(spark, path, ["log_month"]):
            at = slice_path(path, spec)
            if sum(not n.startswith(("_", ".")) for n in files.children(spark, at)) > LOG_FILES:
                write_silver(spark.read.schema(rows.schema).parquet(at).coalesce(1), path, spec)
    finally:
        claims.release(spark, claim)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A control or error log; empty before its first record."""
    if not files.partitions(spark, path, ["log_month"]):
        return spark.createDataFrame([], schema)
    snapshots.recover(spark, path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def log_control(spark: SparkSession, path: str, records: list[dict]) -> None:
    """K8: append control-log records (run_id, run_month, source, table, status,
    records_out, started_at, ended_at, note); missing times are now."""
    rows = [(r.get("run_id"), r.get("run_month"), r.get("source"), r.get("table"), r.get("status"),
             int(r.get("records_out") or 0), r.get("started_at"), r.get("ended_at"), r.get("note"))
            for r in records]
    _append_log(spark.createDataFrame(rows, CONTROL_SCHEMA)
                .withColumns({c: F.coalesce(c, X.now_utc()) for c in ("started_at", "ended_at")}), path, F.col("ended_at"))


def log_error(spark: SparkSession, path: str, run_id: str, source: str, table: str, step: str,
              error_code: str, message: str, severity: str = "ERROR") -> None:
    """K9: append one error record, the message whole."""
    _append_log(spark.createDataFrame([(run_id, None, source, table, step, severity, error_code, message)], ERROR_SCHEMA)
                .withColumn("ts", X.epoch_seconds()), path, X.now_utc())


def register_table(spark: SparkSession, name: str, path: str, schema: str, fmt: str = "parquet",
                   partition_cols: list[str] | None = None, replace_table: bool = True,
                   options: dict | None = None) -> None:
    """(re)create a catalog table over files at ``path`` with the declared
    ``schema`` (DDL text, partition columns included).  The partitions that are
    there are added once, from the folders' names; later ones by the jobs that
    write them (``add_partition``).  ``options`` go to the reader (a CSV's header)."""
    if replace_table:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    opts = f" OPTIONS ({', '.join(f'{k} {v!r}' for k, v in options.items())})" if options else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {fmt}{opts}{parts} LOCATION '{path}'")
    known = files.partitions(spark, path, partition_cols) if partition_cols else []
    for at in range(0, len(known), 500):
        specs = " ".join(f"PARTITION ({_spec(s)}) LOCATION '{slice_path(path, s)}'" for s in known[at:at + 500])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def _spec(spec: dict) -> str:
    return ", ".join(f"{k}={v!r}" for k, v in spec.items())


def add_partition(spark: SparkSession, name: str, spec: dict, location: str | None = None) -> None:
    """ALTER TABLE ... ADD IF NOT EXISTS PARTITION."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({_spec(spec)}){loc}")
