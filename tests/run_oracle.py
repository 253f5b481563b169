"""Run queries against their oracle: python tests/run_oracle.py [sf_dir] [name ...]"""
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle import compare, duck  # noqa: E402
from tarmac.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session()
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sqls:
            probs = compare(df, con, sqls[name])
        else:
            n = df.count()
            probs = []
            print(f"  (rows only: {n})", end="")
    except Exception as e:  # noqa: BLE001
        probs = [f"ERROR {type(e).__name__}: {str(e)[:800]}"]
        traceback.print_exc(limit=2)
    status = "OK " if not probs else "BAD"
    bad += bool(probs)
    print(f"{status} {name} {time.time() - t:.1f}s {'; '.join(probs)}", flush=True)
print(f"{bad} failing")
