"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_util [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _ordered(sql: str) -> bool:
    """Whether the SQL's last clause, outside any bracket, sorts its rows."""
    flat, depth = "", 0
    for ch in sql.upper():
        depth += (ch == "(") - (ch == ")")
        flat += ch if not depth else " "
    return "ORDER BY" in flat


def _rows(cols, rows, keep_order=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    if keep_order:
        return out
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, fn=None, sql=None):
    import __spark_entry__ as E
    fn = fn or E.queries()[name]
    sql = sql or E.oracle_sql()[name]
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows, _ordered(sql)), _rows(d_cols, d_rows, _ordered(sql))
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} rows differ, first: spark={diff[0][0]} duck={diff[0][1]}")
    return {"name": name, "rows": len(s_rows), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2), "problems": problems}


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from snapmart.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(E.oracle_sql())
    spark = build_session("local[8]", shuffle_partitions=8)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": n, "problems": [f"{type(e).__name__}: {str(e)[:600]}"]}
        bad += bool(r["problems"])
        print(("OK  " if not r["problems"] else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv[1:])
