"""Times the SQL twins on the embedded engine, as a yardstick for the bench.

    python -m verification.baseline [sf_dir] [threads]

As in the bench, metrics read prepared silver tables from parquet files.
"""

from __future__ import annotations

import json
import statistics
import sys
import tempfile
import time

from verification import oracle
from verification.check import oracle_connection

_PREPARED = ("segments", "bills", "items", "event_bills")


def main(sf_dir: str, threads: int) -> None:
    connection = oracle_connection(sf_dir)
    connection.execute(f"SET threads = {threads}")
    folder = tempfile.mkdtemp(prefix="billweave-baseline-")
    twins = oracle.oracle_sql()
    for view in _PREPARED:
        connection.execute(f"COPY ({oracle.view_sql(view)}) TO '{folder}/{view}.parquet'")
    raw = {name for name in twins if name.startswith(("silver_", "bronze_", "incremental_", "stream_"))}
    for view in _PREPARED:
        oracle.VIEWS[view] = f"SELECT * FROM '{folder}/{view}.parquet'"
    prepared = oracle.oracle_sql()
    times = {}
    for name in twins:
        sql = twins[name] if name in raw else prepared[name]
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            connection.execute(f"CREATE OR REPLACE TEMP TABLE result AS {sql}")
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 4)
    print(json.dumps({"total": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    arguments = sys.argv[1:] + ["/root/testdata/sf0.1", "4"][len(sys.argv) - 1 :]
    main(arguments[0], int(arguments[1]))
