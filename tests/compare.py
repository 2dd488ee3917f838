"""Compare registered queries with their SQL twins run by DuckDB on the same files.

Usage: python tests/compare.py [folder] [name or prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            v = 0.0
        return f"f:{v!r}"
    if isinstance(v, int):
        return f"i:{v}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, fn, sql):
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    want_cols = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"{len(a)} rows != {len(b)} rows, first {diff}"
    if not a:
        return "no rows"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tallyrill.session import local_session

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    spark = local_session()
    con = duck(folder)
    twins = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if name in twins:
                problem = compare(spark, con, folder, name, fn, twins[name])
            else:
                df = fn(spark, folder)
                got = df.collect()
                problem = None if got else "no rows"
                if args:
                    print("   ", got[:3])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.2f}s {'' if name in twins else '(rows only)'} {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() and 1)
