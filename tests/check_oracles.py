"""Run every registered query against its oracle: python tests/check_oracles.py [sf_dir] [names...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from harness import compare, duck  # noqa: E402
from quire.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]", 8)
con = duck(sf)
qs, os_ = E.queries(), E.oracle_sql()
bad = 0
for n in (names or sorted(qs)):
    t = time.time()
    if n not in os_:
        try:
            c = qs[n](spark, sf).count()
            print(f"ROWS  {n}: {c} rows ({time.time()-t:.1f}s)")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {n}: {str(e)[:800]}")
        continue
    try:
        ok, msg = compare(qs[n](spark, sf), con, os_[n])
    except Exception as e:  # noqa: BLE001
        ok, msg = False, "EXC " + str(e)[:1500]
    bad += not ok
    print(f"{'OK   ' if ok else 'FAIL '} {n}: {msg} ({time.time()-t:.1f}s)")
print("failures:", bad)
