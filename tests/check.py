"""python tests/check.py [sf] [name-prefix ...] — compare registered queries with their SQL.

With TIGHT=1 the size limits are so small that every query takes its split plans.
"""

import os
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

import __spark_entry__ as entry  # noqa: E402
from oracle import compare  # noqa: E402

from fieldhouse.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("TIGHT"):
        for name, value in (("group_rows", 200), ("broadcast_rows", 20), ("probe_free_bytes", 0), ("broadcast_free_bytes", 0)):
            spark.conf.set(f"fieldhouse.{name}", str(value))
    d, sqls, bad = f"/root/testdata/sf{sf}", entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            if name in sqls:
                out = compare(spark, fn, sqls[name], d)
                note = "ok" if not out else "DIFF " + " | ".join(out)
            else:
                note = f"rows only: {fn(spark, d).count()}"
                out = []
        except Exception as e:  # noqa: BLE001
            out, note = ["x"], f"ERROR {type(e).__name__}: {str(e)[:700]}"
        bad += bool(out)
        print(f"{name:32s} {time.time() - t:6.2f}s {note}", flush=True)
    print("failures:", bad)
