"""Run registered queries against their oracles from the command line.

    python tests/run_oracles.py [sf_dir] [key ...]
"""
from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from panelscore.session import get_spark  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith(("/", "--"))]
    if "--default-session" in argv:  # as the driver may call us: Spark's defaults, nothing of ours
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_spark("oracles", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k in sqls:
                ok, msg = compare(df, sqls[k], con)
            else:
                ok, msg = True, f"rows-only: {df.count()} rows, columns {df.columns}"
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:3000]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:28s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
