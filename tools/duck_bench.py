"""Time the oracle SQL in DuckDB (single process, same machine) as a single-node reference point.

Usage: python tools/duck_bench.py [sf_dir] [threads]   -> one JSON line, median of 3 runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.compare import duck  # noqa: E402
from wardline.plans.oracle_sql import ORACLE_SQL  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duck(sf_dir)
    con.execute(f"SET threads = {threads}")
    out = {}
    for name, sql in ORACLE_SQL.items():
        ts = []
        for _ in range(4):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts[1:]), 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "threads": threads, "queries": out,
                      "total": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
