"""Run every registered query against its SQL twin (or just run it when it
has none) and print one line per query. Usage:

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_mod  # noqa: E402
from keelson.session import local_session  # noqa: E402
from tests.oracle import compare, duck_connection  # noqa: E402


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    con = duck_connection(sf)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                ok, msg = compare(df, sqls[name], con)
            else:
                ok, msg = True, f"{df.count()} rows (no SQL twin)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:26s} {time.time() - t:6.2f}s  {msg}", flush=True)
    extra = set(sqls) - set(qs)
    if extra:
        print("SQL without query:", sorted(extra))
        bad += 1
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
