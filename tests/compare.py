"""Compare every query with its SQL: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

import __spark_entry__ as entry


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value if value is None or isinstance(value, bool) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    ours, theirs = _rows(df.columns, rows), _rows(result.columns, result.fetchall())
    if ours == theirs:
        return None
    return f"{len(rows)} rows; only ours {list((ours - theirs).items())[:2]}; only SQL {list((theirs - ours).items())[:2]}"


def main() -> int:
    from tracehouse.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = local_session(8), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report all queries, not only the first that fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        note = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}{note} {(problem or '')[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
