"""Command line: python tests/run_checks.py [sf] [name ...] compares queries with their oracles."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import DATA, connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidewater.session import build_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"{DATA}/sf{sf}"
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:]
    bad = 0
    for name, run in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.perf_counter()
        try:
            actual = run(spark, sf_dir).toPandas()
            took = time.perf_counter() - start
            if name in oracles:
                problems = differences(actual, con.execute(oracles[name]).df())
                verdict = "ok" if not problems else "BAD " + "; ".join(problems)[:600]
            else:
                verdict = f"rows-only ({len(actual)})"
        except Exception as error:
            took = time.perf_counter() - start
            verdict = "ERROR " + "".join(traceback.format_exception_only(error))[:700]
        bad += verdict.startswith(("BAD", "ERROR"))
        print(f"{took:6.2f}s {name}: {verdict}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
