"""Run queries next to their SQL twins.

    python -m tests.compare SF_DIR [name ...]
"""

import datetime as dt
import math
import os
import sys
import time

import duckdb

import __spark_entry__ as entry
from folioflow.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """None where both agree, else what differs; and the seconds each took."""
    start = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    got = frame.collect()
    mid = time.time()
    result = con.execute(entry.oracle_sql()[name])
    want = result.fetchall()
    columns = [d[0] for d in result.description]
    took = (mid - start, time.time() - mid)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", took
    types = {d[0]: str(d[1]) for d in result.description}
    a, b = rows_of(frame.columns, got), rows_of(columns, want)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        return (f"{len(a)} rows != {len(b)} rows; only here {sorted(left)[:2]};"
                f" only there {sorted(right)[:2]}"), took
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    wrong = {c: (t, types[c]) for c, t in frame.dtypes if kinds.get(t) != types[c]}
    return (f"types {wrong}" if wrong else None), took


if __name__ == "__main__":
    sf = sys.argv[1]
    session = local_session(os.environ.get("BENCH_CPUS", "8"))
    con = connect(sf)
    bad = 0
    for key in sys.argv[2:] or list(entry.queries()):
        if key not in entry.oracle_sql():
            print(f"{key:30s} no twin")
            continue
        try:
            problem, (ours, theirs) = compare(session, con, key, sf)
            print(f"{key:30s} {ours:6.2f}s {theirs:6.2f}s {'ok' if problem is None else problem}"[:700])
        except Exception as error:
            problem = error
            print(f"{key:30s} {type(error).__name__} {str(error)[:500]}")
        bad += problem is not None
    print("differences:", bad)
