"""Compare all queries (or the named ones) with their SQL: run_oracle.py [folder] [name …]."""

import os
import sys
import time

_TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_TESTS), _TESTS]

import __spark_entry__ as entry
from oracle import compare, connect
from stationflow.session import local_session

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = local_session("8")
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
bad = []
for name, run in entry.queries().items():
    if names and name not in names:
        continue
    started = time.time()
    try:
        same, count, extra = compare(run(spark, folder), con, entry.oracle_sql()[name])
    except Exception as error:  # noqa: BLE001
        same, count, extra = False, -1, str(error)[:1500]
    print(f"{'ok ' if same else 'BAD'} {name} rows={count} {time.time() - started:.1f}s", flush=True)
    if not same:
        bad.append(name)
        print("    ", str(extra)[:1500])
print("bad:", bad)
