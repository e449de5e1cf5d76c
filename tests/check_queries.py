"""Run registered queries against DuckDB: python -m tests.check_queries [sf] [name ...]."""

import sys
import time

from tests.oracle import compare, connect
from wattloom.catalog import QUERIES, SQL, load_all
from wattloom.session import build_session


def main() -> None:
    args = sys.argv[1:]
    sf = f"/root/testdata/sf{args[0] if args else '0.01'}"
    load_all()
    names = args[1:] or list(QUERIES)
    spark, con = build_session(cores=8), connect(sf)
    failed = 0
    for name in names:
        began = time.time()
        try:
            if name in SQL:
                issue = compare(QUERIES[name](spark, sf), con, SQL[name])
            else:
                n = QUERIES[name](spark, sf).count()
                issue = None if n else "no rows"
        except Exception as e:  # report and go on
            issue = f"{type(e).__name__}: {str(e)[:700]}"
        failed += issue is not None
        print(f"{'ok  ' if issue is None else 'FAIL'} {name} {time.time() - began:.1f}s {issue or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")


if __name__ == "__main__":
    main()
