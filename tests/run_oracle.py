"""Run every queries() key against its oracle: python tests/run_oracle.py [sf_dir] [key ...]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from marketlens.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            try:
                n = fn(spark, sf_dir).count()
                print(f"{name:32s} rows-only {n} rows {time.time()-t:.1f}s")
            except Exception as ex:  # noqa: BLE001
                bad += 1
                print(f"{name:32s} ERROR {type(ex).__name__}: {str(ex)[:300]}")
            continue
        try:
            info = compare(spark, con, fn, sqls[name], sf_dir)
        except Exception as ex:  # noqa: BLE001
            bad += 1
            print(f"{name:32s} ERROR {type(ex).__name__}: {str(ex)[:400]}")
            continue
        ok = info["values_ok"] and info["spark_rows"] == info["oracle_rows"]
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {info['spark_rows']}/{info['oracle_rows']} "
              f"{time.time()-t:.1f}s" + ("" if ok else " " + json.dumps(info, default=str)[:900]))
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
