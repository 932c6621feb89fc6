"""Run queries on a data folder and compare them with their SQL in DuckDB.

python -m verification.check [--folder DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback

import duckdb

from tradeloom.session import build_session
from verification import views
from verification.catalog import QUERIES


def _plain(value):
    if hasattr(value, "normalize") and not isinstance(value, str):
        return value.normalize()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, folder: str, name: str) -> tuple[str, str]:
    entry = QUERIES[name]
    start = time.time()
    df = entry.run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    sql = entry.oracle()
    if sql is None:
        return "rows", f"{len(rows)} rows {spent:.1f}s"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} / {sorted(names)}"
    a, b = _rows(df.columns, rows), _rows(names, theirs)
    if a == b:
        note = "" if rows else " EMPTY"
        return "ok", f"{len(rows)} rows {spent:.1f}s{note}"
    differing = [(x, y) for x, y in zip(a, b) if x != y][:2]
    only = len(set(map(repr, a)) - set(map(repr, b)))
    return "FAIL", f"{len(a)} / {len(b)} rows, {only} differ, e.g.\n   {sorted(df.columns)}\n   " + "\n   ".join(
        f"{x}\n   {y}" for x, y in differing
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    options = parser.parse_args()
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in views.TABLES:
        connection.execute(f"create view {table} as select * from '{options.folder}/{table}.parquet'")
    failed = []
    for name in options.names or QUERIES:
        try:
            state, note = compare(spark, connection, options.folder, name)
        except Exception as error:
            state, note = "ERROR", "".join(traceback.format_exception_only(error))[:1500]
        print(f"{state:6} {name}: {note}", flush=True)
        if state in ("FAIL", "ERROR"):
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
