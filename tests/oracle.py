"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

``python tests/oracle.py <folder> [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from shelfwise.session import local_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder: str, name: str) -> str:
    run, sql = entry.queries()[name], entry.oracle_sql().get(name)
    frame = run(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return f"rows only ({len(got)})"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"MISMATCH columns {sorted(frame.columns)} != {sorted(columns)}"
    if got != want:
        extra, lost = [r for r in got if r not in want][:2], [r for r in want if r not in got][:2]
        return f"MISMATCH {len(got)} rows, expected {len(want)}; spark only {extra}; sql only {lost}"
    if not got:
        return "ok but EMPTY"
    return f"ok ({len(got)})"


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names or entry.queries():
        start = time.time()
        try:
            verdict = compare(spark, con, folder, name)
        except Exception as problem:  # noqa: BLE001
            verdict = f"MISMATCH error {type(problem).__name__}: {str(problem)[:600]}"
        bad += "MISMATCH" in verdict or "EMPTY" in verdict
        print(f"{name:32} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
