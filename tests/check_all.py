"""Run every registered query against its SQL: ``python tests/check_all.py [folder] [prefix ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import ORACLES, QUERIES, compare, connect

from millrace.session import get_spark

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = get_spark("check", cores=8)
con = connect(folder)
bad = 0
for key in QUERIES:
    if wanted and not any(key.startswith(w) for w in wanted):
        continue
    start = time.time()
    try:
        problem = compare(spark, con, folder, key)
    except Exception as e:  # report and go on with the next query
        problem = f"{type(e).__name__}: {str(e)[:600]}"
    took = time.time() - start
    kind = "" if key in ORACLES else " (rows only)"
    if problem:
        bad += 1
        print(f"FAIL {key} {took:.1f}s{kind}: {problem}", flush=True)
    elif took > 3 or wanted:
        print(f"ok   {key} {took:.1f}s{kind}", flush=True)
print(f"{len(QUERIES)} queries, {len(ORACLES)} with SQL, {bad} failed")
