"""Compare every query with its SQL on one scale folder.

usage: python tools/check_oracle.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, folder):
    started = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    if sql is None:
        return f"rows-only {len(got)} ({seconds:.1f}s)", True
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    wanted = result.fetchall()
    types = (
        ",".join(f"{c}:{t}" for c, t in sorted(df.dtypes)),
        ",".join(f"{c[0]}:{c[1]}" for c in sorted(result.description, key=lambda c: c[0])),
    )
    if sorted(df.columns) != sorted(columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}", False
    a, b = _rows(got, df.columns), _rows(wanted, columns)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"DIFF rows {len(a)} vs {len(b)}\n   spark {only_a}\n   sql   {only_b}\n   {types[0]}\n   {types[1]}", False
    return f"ok {len(a)} ({seconds:.1f}s)   {types[0]} | {types[1]}", True


def main() -> int:
    from civiframe.catalog import ORACLE, QUERIES
    from civiframe.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {table} as select * from '{path}'")
    failed = []
    for name in names:
        try:
            text, fine = compare(spark, con, name, QUERIES[name], ORACLE.get(name), folder)
        except Exception as error:  # report and go on with the next query
            text, fine = f"ERROR {type(error).__name__}: {str(error)[:1500]}", False
        print(f"{name}: {text}", flush=True)
        if not fine:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} fine; failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
