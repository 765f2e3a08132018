"""Run every registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables; compare row count, column names and types, and the multiset of
values.

    python tools/oracle_check.py [SF_DIR] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import os

STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare doubles bit for bit

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("num", repr(v) if STRICT else repr(round(v, 9)))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("v", v)


def rows_multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(df, rel) -> list:
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if dt.get(f.name) != SPARK_TO_DUCK.get(t, t.upper()):
            out.append((f.name, t, dt.get(f.name)))
    return out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    from tallyhouse.plans.oracle import all_sql
    from tallyhouse.plans.queries import all_queries
    qs, sqls = all_queries(), all_sql()
    con = duck(sf_dir)
    results = {}
    for k, fn in qs.items():
        if keys and k not in keys:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_names = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if k not in sqls:
                results[k] = ("NO_SQL", len(s_rows))
                continue
            cur = con.execute(sqls[k])
            d_names = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
            ok_names = sorted(s_names) == sorted(d_names)
            ok_n = len(s_rows) == len(d_rows)
            ms, md = rows_multiset(s_names, s_rows), rows_multiset(d_names, d_rows)
            ok_v = ms == md
            bad_types = type_mismatches(df, con.sql(sqls[k]))
            status = "OK" if (ok_names and ok_n and ok_v and not bad_types) else "MISMATCH"
            results[k] = (status, len(s_rows), len(d_rows))
            if verbose:
                print(f"{k:28s} {status:8s} spark={len(s_rows):7d} duck={len(d_rows):7d} "
                      f"spark_s={t1 - t0:6.2f}", flush=True)
            if status != "OK" and verbose:
                if bad_types:
                    print("   types:", bad_types)
                if not ok_names:
                    print("   names:", sorted(s_names), sorted(d_names))
                else:
                    only_s = list((ms - md).items())[:3]
                    only_d = list((md - ms).items())[:3]
                    print("   spark-only:", only_s)
                    print("   duck-only :", only_d)
        except Exception as e:  # report and continue
            results[k] = ("ERROR", str(e)[:300])
            if verbose:
                print(f"{k:28s} ERROR {type(e).__name__}: {str(e)[:500]}", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tallyhouse.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] != "OK"]
    print(f"{len(res) - len(bad)}/{len(res)} OK; not OK: {bad}")
