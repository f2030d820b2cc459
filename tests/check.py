"""Run registered queries next to their checking SQL and compare all rows: python tests/check.py [sf] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    """Exact value with its kind, so 1, 1.0, True and '1' all differ. Doubles are compared at 9 digits."""
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else f"{value:.9g}")
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, connection, sf_dir: str, name: str, query, sql: str | None) -> str | None:
    """None when both agree, otherwise what differs."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    if sql is None:
        return None if got else "no rows"
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    want = rows_of(columns, cursor.fetchall())
    if got == want:
        return None if got else "both empty"
    a, b = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows against {len(want)}\n   spark only: {sorted(a)[:2]}\n   sql only:   {sorted(b)[:2]}"


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, connection = local_session("check"), duck(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name, query, oracle.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
