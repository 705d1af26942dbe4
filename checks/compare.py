"""Run queries in Spark and their SQL in DuckDB and compare the full results.

Usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from loanlake.plans.catalog import QUERIES, run_query
from loanlake.session import local_session

DEFAULT_FOLDER = "/root/testdata/sf0.01"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_value(r[i])).__name__, _value(r[i])) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both hold the same columns and the same bag of typed rows."""
    theirs = con.execute(sql)
    their_columns = [c[0] for c in theirs.description]
    if sorted(spark_df.columns) != sorted(their_columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(their_columns)}"]
    ours = _rows(spark_df.columns, spark_df.collect())
    expected = _rows(their_columns, theirs.fetchall())
    if ours == expected:
        return []
    return [
        f"{ours.total()} rows against {expected.total()}",
        *[f"only Spark: {r}" for r in list((ours - expected))[:2]],
        *[f"only SQL:   {r}" for r in list((expected - ours))[:2]],
    ]


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or list(QUERIES):
        started = time.monotonic()
        found = differences(run_query(name, spark, folder), con, ORACLES[name])
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.monotonic() - started:.2f}s", flush=True)
        for line in found:
            print("    ", line)
        failed += bool(found)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main((sys.argv[1:] or [DEFAULT_FOLDER])[0], sys.argv[2:])))
