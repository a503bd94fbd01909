"""Time the oracle SQL (the reference's literal query shape) in DuckDB with
one thread, as the reference's mart profile configures; median of 3 after a
warm-up.  usage: python tools/duckdb_baseline.py [sf_dir] [threads]"""
import json, os, statistics, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from bench import HEADLINE  # noqa: E402
from medallion.catalogue import oracle_sql  # noqa: E402
from medallion.oracle_compare import duckdb_connection  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
threads = int(sys.argv[2]) if len(sys.argv) > 2 else 1
con = duckdb_connection(sf)
con.execute(f"SET threads={threads}")
sql = oracle_sql()
out = {}
for name in HEADLINE:
    ts = []
    for i in range(4):
        t0 = time.perf_counter(); con.execute(sql[name]).fetchall(); dt = time.perf_counter() - t0
        if i: ts.append(dt)
    out[name] = round(statistics.median(ts), 3)
print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf, "queries": out,
                  "sum": round(sum(out.values()), 3)}))
