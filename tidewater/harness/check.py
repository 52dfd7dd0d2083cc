"""Local oracle check: run registered queries in Spark and their SQL in DuckDB, compare.

    python -m tidewater.harness.check [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

from ..session import build_session
from .catalog import QUERIES
from .compare import diff
from .standins import BASE_TABLES


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(a.sf)
    names = a.names or list(QUERIES)
    bad = 0
    for name in names:
        fn, sql = QUERIES[name]
        t0 = time.time()
        try:
            df = fn(spark, a.sf)
            rows = df.collect()
            t1 = time.time()
            if sql is None:
                print(f"{name:32s} rows={len(rows):7d} spark={t1 - t0:5.1f}s  (no SQL oracle)")
                continue
            cur = con.execute(sql)
            drows = cur.fetchall()
            res = diff(df.columns, rows, [d[0] for d in cur.description], drows)
            status = "OK" if res is None else "FAIL " + res
            bad += res is not None
            print(f"{name:32s} rows={len(rows):7d} spark={t1 - t0:5.1f}s  {status}")
        except Exception as e:  # report and continue with the next query
            bad += 1
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:600]}")
        sys.stdout.flush()
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
