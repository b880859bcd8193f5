"""Run catalogue queries in Spark and their SQL twins in DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (columns sorted
by name, floats compared exactly after the rounding both sides apply).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(time.time() - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = "VALUES"
        res["diff"] = diff
        res["n_diff"] = sum(1 for x, y in zip(a, b) if x != y)
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tessera.runtime import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    q, o = queries(), oracle_sql()
    con = duck(sf_dir)
    for name in (names or list(q)):
        try:
            r = compare(spark, sf_dir, name, q[name], o.get(name), con)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main(sys.argv)
