"""Run registered queries against their SQL in DuckDB: ``python tools/parity.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.plans import CATALOG  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck_connection(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "<null>" if value is None else f"{type(value).__name__}:{value}"


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, connection, name: str, folder: str) -> str:
    """``''`` when both sides agree, else what differs."""
    query = CATALOG[name]
    frame = query.run(spark, folder)
    ours = [tuple(r) for r in frame.collect()]
    if query.sql is None:
        return "" if ours else "no rows"
    result = connection.execute(query.sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    left, right = bag(frame.columns, ours), bag(columns, theirs)
    if left == right:
        return ""
    differing = next(((a, b) for a, b in zip(left, right) if a != b), None)
    return f"{len(left)} rows against {len(right)}; first difference {differing}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CATALOG)
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck_connection(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        rows = CATALOG[name].sql is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s{'' if rows else ' (rows only)'} {problem}", flush=True)
        failed += bool(problem)
    print(f"{len(names) - failed}/{len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
