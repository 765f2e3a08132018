"""Benchmark the headline queries.

Runs each query over $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line.  Each query is executed in full
with the ``noop`` sink (every row produced, nothing collected to the driver).
All queries run twice in one process: the first (cold) pass pays class
loading, code generation and JIT for this scale's plans; ``value`` is the
total of the second (warm) pass, ``cold_value`` that of the first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "orders_valid", "orders_invalid", "orders_split_audit", "orders_dedup_latest",
    "ingest_month_filter", "backfill_months", "customer_valid", "store_valid", "product_valid",
    "dim_product_flatten", "budget_clean", "dq_manifest_rules", "fk_orphans", "fact_projection",
    "fact_new_months", "classify_keys", "v_sales", "v_calendar_month_loaded", "total_sales",
    "total_sales_header", "budget_compliance", "cumulative_sales", "gross_margin",
    "store_compliance_bands", "margin_by_country", "store_diversity", "sales_by_month_country",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from tallyhouse.plans.queries import all_queries
    from tallyhouse.session import build_session

    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(f"local[{cpus}]", app="tallyhouse-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = all_queries()

    def run_all() -> dict[str, float]:
        out = {}
        for name in names:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t0, 3)
        return out

    # pass 1 (cold: class loading, code generation, JIT of this scale's plans),
    # pass 2 (warm, steady state) - both over the full tables, both reported
    cold = run_all()
    warm = run_all()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf, "cpus": int(cpus),
                      "cold_value": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
