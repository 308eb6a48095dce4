"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with a short reason.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~none",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return "ROWS", f"{len(s_rows)} rows (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return "MISMATCH", f"columns spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return "MISMATCH", f"rows spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return "MISMATCH", f"values differ e.g. {diffs}"
    return "OK", f"{len(s_rows)} rows {t1 - t0:.1f}s"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from cohortlens.plans import registry
    from cohortlens.session import get_spark

    spark = get_spark(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            status, msg = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            status, msg = "ERROR", f"{type(e).__name__}: {str(e)[:300]}"
        bad += status in ("MISMATCH", "ERROR")
        print(f"{status:9s} {name}: {msg}", flush=True)
    print(f"done, {bad} failing")


if __name__ == "__main__":
    main()
