"""Compare registered queries with their SQL twins: python tests/check_oracle.py [sf_dir] [names..]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from bazaarlens.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty text if both sides give the same rows, else what differs."""
    frame = entry_points.queries()[name](spark, sf_dir)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(columns)}"
    if ours != theirs:
        left, right = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"{len(ours)} and {len(theirs)} rows; only ours {sorted(left, key=repr)[:2]}; only SQL {sorted(right, key=repr)[:2]}"
    return "" if ours else "both empty"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf_dir)
    bad = 0
    for query in sys.argv[2:] or entry_points.queries():
        began = time.time()
        try:
            difference = compare(session, duck, sf_dir, query)
        except Exception as error:  # report and go on with the other queries
            difference = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {query} {time.time() - began:.1f}s {difference}", flush=True)
    sys.exit(bool(bad))
