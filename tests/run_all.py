"""Compare every query with its oracle: `python tests/run_all.py <sf dir> [names...]`."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from terrawatt.session import build_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402


def main() -> None:
    sf, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            problem = compare(df, con, oracles[name]) if name in oracles else (None if df.count() else "no rows")
        except Exception as err:  # report and go on
            problem = f"{type(err).__name__}: {str(err)[:500]}"
        took = time.time() - start
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {took:6.1f}s {name}" + ("" if problem is None else f"  -> {problem}"), flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
