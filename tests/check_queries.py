"""Run registered queries against their oracle SQL: ``python tests/check_queries.py [sf_dir] [name part ...]``."""

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


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool) or isinstance(v, str):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 9)
    try:
        return round(float(v), 9)
    except (TypeError, ValueError):
        return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(df, con, sql) -> str:
    got = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    import __spark_entry__ as entry
    from emberlog.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                n = df.count()
                problem = "" if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
