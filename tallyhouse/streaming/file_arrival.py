"""File-arrival fact loading with Structured Streaming.

The stream carries the arriving files, not their rows: each new
``orders_YYYY-MM.csv`` (a landed month file) or ``orders_YYYY-MM.ready`` (the
ingest job's marker of a complete bronze slice) is seen once, by the file
source's checkpoint, without opening it.  So a broken file cannot fail the
stream, and one without data rows is still seen (files of no bytes, which
Spark's sources pass over, are taken from the folder's listing).  ``foreachBatch`` applies the load
protocol (I3) to the files of a micro-batch in name order:

* the month comes from the file name (F19); other names -> IGNORED_BAD_NAME;
* a month already in fact_sales, taken by an earlier file, or claimed by another
  loader at work (``claims``) -> SKIPPED_EXISTS;
* a file that cannot be read -> ERROR with the whole message; no data rows ->
  SKIPPED_EMPTY_FILE; both leave the month to a later file;
* the rest is projected (L5) and written with dynamic partition overwrite on
  RunMonth, so a replayed batch rewrites the same partitions, never duplicates.

One status row per file is recorded before the fact write, under the stream's
query id and batch id.  A replay of that batch uses the recorded decisions; a
new checkpoint is another query and decides anew.  A file that fails only
while it is written turns its own status into ERROR and stops no other file.
"""

from __future__ import annotations

import logging
import re
import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.functions import exprs as X
from tallyhouse.operators import warehouse as W
from tallyhouse.sinks import claims
from tallyhouse.sinks import writers as K
from tallyhouse.sources import bronze as B
from tallyhouse.sources import files

log = logging.getLogger(__name__)

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
STATUS_SCHEMA = ("file_path string, RunMonth string, status string, rows_file bigint, rows_inserted bigint, "
                 "error string, query_id string, batch_id bigint")
MARKER_MONTH = r"orders_(\d{4}-\d{2})\.(?:csv|ready)$"


def _source(spark: SparkSession, path: str, month: str, bronze_orders: str | None) -> str:
    """Where the rows of an arrived file are, as a full URI."""
    if path.endswith(".ready") and bronze_orders:
        path = B.month_folder(bronze_orders, month)
    return files.qualified(spark, path)


def _read(spark: SparkSession, sources: list[str]) -> DataFrame:
    """Raw order rows of month files and bronze slices, with their file and RunMonth."""
    path = F.col("_metadata.file_path")
    of_slice = F.concat(F.regexp_extract(path, r"/year=(\d+)/month=\d+/", 1), F.lit("-"),
                        F.lpad(F.regexp_extract(path, r"/year=\d+/month=(\d+)/", 1), 2, "0"))
    return (spark.read.schema(B.raw_schema("orders")).option("header", True).option("escape", '"').csv(sources)
            .withColumns({"file_path": path, "RunMonth": F.coalesce(X.month_from_key(path), of_slice)}))


def _rows_per_source(spark: SparkSession, sources: list[str]) -> tuple[dict, dict]:
    """Rows of each source, and the message of each that cannot be read.  One
    job for all; only if it fails is each tried on its own."""
    if not sources:
        return {}, {}
    plain = {re.sub(r"^(\w+):/+", r"\1:/", s): s for s in sources}     # file:/x and file:///x are one
    try:
        counts = dict.fromkeys(sources, 0)
        for r in _read(spark, sources).groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).collect():
            at = re.sub(r"^(\w+):/+", r"\1:/", unquote(r["file_path"]))
            counts[plain.get(at) or plain[at.rsplit("/", 1)[0]]] += r["n"]   # a file, or one of a slice
        return counts, {}
    except Exception as e:
        if len(sources) == 1:
            return {}, {sources[0]: str(e)}
    counts, errors = {}, {}
    for s in sources:
        c, e = _rows_per_source(spark, [s])
        counts |= c
        errors |= e
    return counts, errors


def _claimed(spark: SparkSession, months: set[str], fact_path: str, owner: str) -> dict:
    """month -> the claim on it, for those that nobody else holds."""
    found = {m: claims.acquire(spark, claims.month_folder(fact_path, m), owner) for m in sorted(months)}
    return {m: c for m, c in found.items() if c}


def _decide(spark: SparkSession, paths: list[str], fact_path: str, bronze_orders: str | None,
            owner: str) -> list[dict]:
    """The I3 protocol: one decision per file, in name order."""
    month = {p: (m[1] if (m := re.search(MARKER_MONTH, p)) else None) for p in paths}
    months = set(month.values()) - {None}
    mine = _claimed(spark, months, fact_path, owner)
    loaded = {m for m in months if m not in mine
              or files.has_data(spark, K.slice_path(fact_path, {"RunMonth": m}))
              and not spark.read.parquet(K.slice_path(fact_path, {"RunMonth": m})).isEmpty()}
    source = {p: _source(spark, p, month[p], bronze_orders) for p in paths if month[p] and month[p] not in loaded}
    counts, errors = _rows_per_source(spark, sorted(set(source.values())))
    out = []
    for p in sorted(paths):
        m, n, error, status = month[p], counts.get(source.get(p), 0), errors.get(source.get(p)), "SUCCEEDED"
        if m is None:
            status = "IGNORED_BAD_NAME"
        elif m in loaded:
            status = "SKIPPED_EXISTS"
        elif error is not None:
            status = "ERROR"
        elif n == 0:
            status = "SKIPPED_EMPTY_FILE"
        else:
            loaded.add(m)
        out.append({"file_path": p, "RunMonth": m, "status": status, "rows_file": n,
                    "rows_inserted": n if status == "SUCCEEDED" else 0, "error": error if status == "ERROR" else None})
    return out


def _record(spark: SparkSession, decisions: list[dict], status_path: str, query_id: str, epoch_id: int) -> None:
    rows = [(d["file_path"], d["RunMonth"], d["status"], d["rows_file"], d["rows_inserted"], d["error"], query_id,
             epoch_id) for d in decisions]
    (spark.createDataFrame(rows, STATUS_SCHEMA).coalesce(1).drop("query_id", "batch_id").write.mode("overwrite")
     .parquet(K.slice_path(status_path, {"query_id": query_id, "batch_id": epoch_id})))


def _recorded(spark: SparkSession, status_path: str, query_id: str, epoch_id: int) -> list[dict]:
    at = K.slice_path(status_path, {"query_id": query_id, "batch_id": epoch_id})
    if not K.is_committed(spark, at):
        return []
    return [r.asDict() for r in spark.read.parquet(at).collect()]        # one row per file of the batch


def record_empty(spark: SparkSession, landing_dir: str, status_path: str, archive_dir: str | None = None) -> None:
    """Status rows for month files of no bytes at all, which no reader reports:
    from the folder's listing, once per path (query id ``empty``).  With an
    archive they are moved there, so the folder holds only what is pending."""
    found = files.empty_files(spark, landing_dir, ".csv")
    mine = K.slice_path(status_path, {"query_id": "empty"})
    fresh = found
    if found and not archive_dir and files.exists(spark, mine):
        known = {r["file_path"] for r in spark.read.parquet(mine).select("file_path").collect()}
        fresh = [p for p in found if p not in known]
    if fresh:
        month = {p: (m[1] if (m := re.search(MARKER_MONTH, p)) else None) for p in fresh}
        _record(spark, [{"file_path": p, "RunMonth": month[p], "rows_file": 0, "rows_inserted": 0, "error": None,
                         "status": "SKIPPED_EMPTY_FILE" if month[p] else "IGNORED_BAD_NAME"} for p in fresh],
                status_path, "empty", time.time_ns())
    if archive_dir:
        for p in found:
            files.rename(spark, p, f"{archive_dir.rstrip('/')}/empty/{time.time_ns()}-{p.rsplit('/', 1)[1]}")


def _load(spark: SparkSession, decisions: list[dict], fact_path: str, bronze_orders: str | None) -> None:
    sources = [_source(spark, d["file_path"], d["RunMonth"], bronze_orders) for d in decisions]
    K.overwrite_slice(W.fact_projection(_read(spark, sources)), fact_path, ["RunMonth"])


def load_batch(arrived: DataFrame, epoch_id: int, fact_path: str, status_path: str,
               query_id: str | None = None, bronze_orders: str | None = None) -> None:
    """The I3 protocol for every file of one micro-batch (column ``path``)."""
    spark = arrived.sparkSession
    query_id = query_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
    owner = f"{query_id}/{epoch_id}"
    decisions = _recorded(spark, status_path, query_id, epoch_id)
    months = {d["RunMonth"] for d in decisions if d["status"] == "SUCCEEDED"}
    try:
        if decisions:                      # a replay: the claims are this batch's own, unless their lease ended
            mine = _claimed(spark, months, fact_path, owner)
            lost = [d for d in decisions if d["status"] == "SUCCEEDED" and d["RunMonth"] not in mine]
            for d in lost:
                d |= {"status": "SKIPPED_EXISTS", "rows_inserted": 0}
            if lost:
                _record(spark, decisions, status_path, query_id, epoch_id)
        else:
            # file names of one micro-batch: bounded by maxFilesPerTrigger
            paths = [r["path"] for r in arrived.select("path").distinct().collect()]
            months = {m[1] for p in paths if (m := re.search(MARKER_MONTH, p))}
            decisions = _decide(spark, paths, fact_path, bronze_orders, owner)
            if not decisions:
                return
            _record(spark, decisions, status_path, query_id, epoch_id)
        _load_accepted(spark, decisions, fact_path, status_path, query_id, epoch_id, bronze_orders)
    finally:
        for m in months:
            claims.release_owned(spark, claims.month_folder(fact_path, m), owner)


def _load_accepted(spark: SparkSession, decisions: list[dict], fact_path: str, status_path: str, query_id: str,
                   epoch_id: int, bronze_orders: str | None) -> None:
    accepted = [d for d in decisions if d["status"] == "SUCCEEDED"]
    if not accepted:
        return
    try:
        _load(spark, accepted, fact_path, bronze_orders)
        return
    except Exception as e:                 # find out which files fail, load the others
        log.warning("batch %s of %s: joint load failed, files are tried one by one: %s", epoch_id, query_id, e)
    for d in accepted:
        try:
            _load(spark, [d], fact_path, bronze_orders)
        except Exception as e:
            d |= {"status": "ERROR", "rows_inserted": 0, "error": str(e)}
    _record(spark, decisions, status_path, query_id, epoch_id)


def start_fact_stream(spark: SparkSession, landing_dir: str, fact_path: str, status_path: str,
                      checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = 1000,
                      bronze_orders: str | None = None, archive_dir: str | None = None) -> StreamingQuery:
    """Start the file-arrival load; ``available_now`` processes what is there
    and stops (a scheduled run), else it keeps watching the folder.  A large
    backlog is split into micro-batches of ``max_files_per_trigger`` files.
    ``bronze_orders`` is where the slices of ``.ready`` markers are.  With
    ``archive_dir`` files of finished batches are moved there (by the source, once
    the next batch begins), so no listing ever sees them again."""
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.{csv,ready}")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def batch(arrived: DataFrame, epoch_id: int) -> None:
        record_empty(arrived.sparkSession, landing_dir, status_path, archive_dir)
        load_batch(arrived, epoch_id, fact_path, status_path, bronze_orders=bronze_orders)

    record_empty(spark, landing_dir, status_path, archive_dir)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    w = r.load(landing_dir).select("path").writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
