"""python tests/check_queries.py [sf] [name-prefix ...] — compare registered queries with DuckDB."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__  # noqa: E402,F401
from callweave.queries.registry import REGISTRY  # noqa: E402
from callweave.session import get_session  # noqa: E402
from harness import compare, duck  # noqa: E402


def main(sf="0.001", *prefixes):
    spark = get_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = duck(folder)
    bad = 0
    for name, q in REGISTRY.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            if q.sql is None:
                n, problems = q(spark, folder).count(), []
                note = "rows only"
            else:
                problems, n = compare(spark, con, folder, q)
                note = "ok" if not problems else "DIFF"
        except Exception as e:  # report and go on with the next query
            problems, n, note = [f"{type(e).__name__}: {str(e)[:600]}"], 0, "ERROR"
        bad += bool(problems)
        print(f"{note:9} {name:45} rows={n:<7} {time.time() - t:.2f}s", flush=True)
        for p in problems:
            print("   ", p)
    print("failing:", bad)
    spark.stop()


main(*sys.argv[1:])
