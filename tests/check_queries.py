"""Command line: python tests/check_queries.py [--sf DIR] [names...]"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tests.oracle import compare, connect  # noqa: E402
from rulemill.session import get_spark  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--conf", action="append", default=[], help="extra setting, key=value")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry
    spark = get_spark("check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1",
        **dict(c.split("=", 1) for c in args.conf)})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    checks, bad = entry.oracle_sql(), 0
    todo = entry.queries()
    names = [n for n in todo if not args.names or any(n.startswith(a) for a in args.names)]
    for name in names:
        t = time.time()
        try:
            df = todo[name](spark, args.sf)
            if name in checks:
                diff = compare(df, con, checks[name])
            else:
                n = len(df.collect())
                diff = [] if n else ["no rows"]
                print(f"rows-only {name} {n}")
        except Exception as e:  # noqa: BLE001
            diff = [f"{type(e).__name__}: {str(e)[:1200]}"]
        bad += bool(diff)
        print(f"{'ok  ' if not diff else 'FAIL'} {name} {time.time() - t:.1f}s {' | '.join(diff)}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
