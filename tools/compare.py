"""Run registered queries next to their SQL in DuckDB and report every difference.

    python tools/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.plans import all_queries  # noqa: E402
from tallyframe.session import local_session  # noqa: E402


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return (type(v).__name__, v)


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def tables_in_duckdb(folder):
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    return con


def compare(spark, con, query, folder, inspect=lambda df: None) -> tuple[bool, str]:
    """Does the query agree with its SQL; ``inspect`` sees the DataFrame before it runs."""
    start = time.time()
    df = query(spark, folder)
    inspect(df)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if query.sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL, {took:.2f}s"
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = as_bag(df.columns, got), as_bag(names, want)
    if a == b:
        return len(got) > 0 or len(want) == 0, f"{len(got)} rows, {took:.2f}s"
    extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
    return False, f"{len(got)} vs {len(want)} rows\n   spark only {extra}\n   sql only   {missing}"


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    con = tables_in_duckdb(folder)
    bad = 0
    for name, q in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, q, folder)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failing")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
