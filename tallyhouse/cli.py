"""Command line for the jobs (spark-submit friendly): the reference's handler
events become sub-commands with the same options.

    spark-submit --py-files tallyhouse.zip tallyhouse/__main__.py ingest \
        --lake hdfs:///lake --manifest hdfs:///lake/sources.json --run-months 2011-06
    python -m tallyhouse silver --lake /data/lake --run-month 2011-06 --refresh-dims
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyhouse")
    sub = p.add_subparsers(dest="cmd", required=True)

    def lake(sp):
        sp.add_argument("--lake", required=True, help="lake root folder (any Hadoop-compatible URI)")
        return sp

    s = lake(sub.add_parser("ingest", help="manifest -> bronze (dims once, orders per month)"))
    s.add_argument("--manifest", required=True)
    s.add_argument("--run-months", nargs="+", required=True)
    s.add_argument("--refresh-dims", action="store_true")
    s.add_argument("--allow-overwrite", action="store_true")
    s.add_argument("--jdbc-url", help="store database (manifest type mysql)")
    s.add_argument("--jdbc-driver")
    s.add_argument("--budget-inbox", help="folder of the budget sheet (manifest type excel)")

    s = lake(sub.add_parser("silver", help="bronze -> silver for one month"))
    s.add_argument("--run-month", required=True)
    s.add_argument("--refresh-dims", action="store_true")
    s.add_argument("--null-policy", choices=["parity", "quarantine"], default="parity")

    s = lake(sub.add_parser("dims", help="warehouse dimensions (SCD1 overwrite)"))
    s.add_argument("--run-month", required=True)
    s.add_argument("--source", choices=["silver", "bronze"], default="silver")

    s = lake(sub.add_parser("load-month", help="load one month file into fact_sales"))
    s.add_argument("--run-month")
    s.add_argument("--key", help="exact file path; wins over --run-month")
    s.add_argument("--source", choices=["silver", "bronze"], default="silver")
    s.add_argument("--catalog", help="database whose fact_sales gets the month's partition")

    s = lake(sub.add_parser("stream", help="file-arrival fact load (available-now run)"))
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--max-files-per-trigger", type=int, default=1000)
    s.add_argument("--archive", help="folder that loaded files are moved to")

    s = lake(sub.add_parser("register", help="catalog tables over the warehouse"))
    s.add_argument("--database", required=True)

    s = lake(sub.add_parser("rollups", help="refresh partial sums of changed months"))
    s.add_argument("--run-months", nargs="*")

    s = lake(sub.add_parser("next-month", help="month the scheduler would request next"))
    s.add_argument("--start", default="2011-05")
    s.add_argument("--end", default="2014-05")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from tallyhouse.plans import jobs as J
    from tallyhouse.session import build_session
    a = _parser().parse_args(argv)
    spark = spark or build_session(app=f"tallyhouse-{a.cmd}")
    lake = J.Lake(a.lake)
    if a.cmd == "ingest":
        jdbc = {"url": a.jdbc_url, "properties": {"driver": a.jdbc_driver} if a.jdbc_driver else None} \
            if a.jdbc_url else None
        out = J.ingest_from_manifest(spark, a.manifest, lake, a.run_months, a.refresh_dims, a.allow_overwrite,
                                     jdbc, {"inbox": a.budget_inbox} if a.budget_inbox else None)
    elif a.cmd == "silver":
        out = J.bronze_to_silver(spark, lake, a.run_month, a.refresh_dims, a.null_policy)
    elif a.cmd == "dims":
        out = J.build_dims(spark, lake, a.run_month, a.source)
    elif a.cmd == "load-month":
        out = J.load_month(spark, lake, run_month=a.run_month, key=a.key, source=a.source, catalog=a.catalog)
    elif a.cmd == "stream":
        from tallyhouse.streaming.file_arrival import start_fact_stream
        q = start_fact_stream(spark, lake.landing_orders, lake.warehouse("fact_sales"), lake.load_status,
                              a.checkpoint, max_files_per_trigger=a.max_files_per_trigger,
                              bronze_orders=lake.bronze_orders, archive_dir=a.archive)
        q.awaitTermination()
        out = {"status": "FINISHED", "batches": len(q.recentProgress), "rollups": J.refresh_rollups(spark, lake)}
    elif a.cmd == "register":
        out = {"tables": J.register_tables(spark, lake, a.database)}
    elif a.cmd == "rollups":
        out = {"run_months": J.refresh_rollups(spark, lake, a.run_months or None)}
    else:
        out = J.next_month_job(spark, lake, a.start, a.end)
    print(json.dumps(out, default=str))
    return out


def run() -> None:
    """Console entry point: exit status 0 on success (the result is printed)."""
    main()
