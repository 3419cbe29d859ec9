"""Run each registered query in Spark and its oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names, and an order-insensitive hash of the values (columns
sorted by name), the way the round check does.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from lodestar.plans.catalog import TABLES  # noqa: E402
from lodestar.session import local_session  # noqa: E402


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if EXACT else repr(round(v, 9))
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    keys = [a for a in args if not os.path.isdir(a)]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        df = qs[k](spark, sf)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t0
        if k not in sqls:
            print(f"{k:26s} rows={len(rows):7d} (rows-only) spark={ts:5.1f}s")
            continue
        t0 = time.time()
        res = con.execute(sqls[k])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        to = time.time() - t0
        h1, l1 = digest(rows, cols)
        h2, l2 = digest(orows, ocols)
        ok = len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
        bad += not ok
        print(f"{k:26s} {'OK ' if ok else 'BAD'} rows={len(rows):7d}/{len(orows):7d} "
              f"spark={ts:5.1f}s duck={to:5.1f}s", flush=True)
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols", cols, ocols)
            s1, s2 = set(l1), set(l2)
            print("   spark-only", sorted(s1 - s2)[:3])
            print("   oracle-only", sorted(s2 - s1)[:3])
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
