"""Run registered queries in Spark and their oracles in DuckDB; print a verdict per query.

usage: python tools/check_queries.py [sf_dir] [name ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.catalogue import oracle_sql, queries  # noqa: E402
from medallion.oracle_compare import compare, duckdb_connection, spark_to_pandas  # noqa: E402
from medallion.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    con = duckdb_connection(sf)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            sp = spark_to_pandas(qs[name](spark, sf))
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: spark failed: {e}"[:2000]); bad += 1; continue
        t1 = time.time()
        if name not in os_:
            print(f"ROWS  {name}: {len(sp)} rows (no oracle) spark={t1-t0:.2f}s"); continue
        try:
            od = con.execute(os_[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: oracle failed: {e}"[:2000]); bad += 1; continue
        ok, msg = compare(sp, od)
        bad += not ok
        print(f"{'OK   ' if ok else 'FAIL '} {name}: {msg} spark={t1-t0:.2f}s")
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
