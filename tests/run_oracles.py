"""Run registered queries against their DuckDB oracles (like the driver).

usage: python tests/run_oracles.py [sf_dir] [name ...]
"""
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import compare, duck  # noqa: E402
from kindred.sources.session import get_session  # noqa: E402
import __spark_entry__ as se  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, os_ = se.queries(), se.oracle_sql()
    con = duck(sf)
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in os_:
                problems, ns, nd = compare(df, con, os_[name])
            else:
                problems, ns, nd = ["(no oracle)"], df.count(), None
        except Exception as e:  # noqa: BLE001
            problems, ns, nd = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], None, None
            traceback.print_exc(limit=2)
        ok = not problems or problems == ["(no oracle)"]
        bad += 0 if ok else 1
        print(f"{'OK ' if ok else 'BAD'} {name:32s} spark={ns} oracle={nd} {time.time()-t:5.1f}s {problems}",
              flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main(sys.argv)
