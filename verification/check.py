"""Runs registered queries next to their SQL twins and compares whole results.

    python -m verification.check [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from billweave.session import build_session
from verification.oracle import oracle_sql
from verification.queries import queries

TABLES = "region nation customer supplier part orders lineitem events".split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal_rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of texts, columns in name order."""
    frame = frame[sorted(frame.columns)]
    text = lambda v: "NULL" if v is None or (not isinstance(v, list) and pd.isna(v)) else str(v)
    return sorted(tuple(text(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def differences(expected: pd.DataFrame, actual: pd.DataFrame) -> list[str]:
    if sorted(expected.columns) != sorted(actual.columns):
        return [f"columns {sorted(actual.columns)} instead of {sorted(expected.columns)}"]
    found = []
    for column in expected.columns:
        kinds = str(expected[column].dtype), str(actual[column].dtype)
        if kinds[0].split("[")[0] != kinds[1].split("[")[0]:
            found.append(f"note: {column} is {kinds[1]} instead of {kinds[0]}")
    left, right = normal_rows(expected), normal_rows(actual)
    if left != right:
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        found.append(
            f"{len(right)} rows instead of {len(left)}; missing e.g. {sorted(only_left)[:2]}, extra e.g. {sorted(only_right)[:2]}"
        )
    return found


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, twins, bad = oracle_connection(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            actual = query(spark, sf_dir).toPandas()
            found = differences(connection.execute(twins[name]).df(), actual) if name in twins else ["note: no SQL twin"]
        except Exception as error:  # noqa: BLE001 - reported per query
            actual, found = pd.DataFrame(), [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed = any(not text.startswith("note") for text in found)
        bad += failed
        seconds = time.perf_counter() - start
        print(f"{'FAIL' if failed else 'ok  '} {name} {len(actual)} rows {seconds:.2f}s", *found, sep="\n     ")
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(1 if main(arguments[0], arguments[1:]) else 0)
