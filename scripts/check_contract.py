"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

usage: python scripts/check_contract.py [sf_dir] [name ...]
Prints one line per query: status, rows, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from recspark.session import build_session  # noqa: E402
from recspark.plans import REGISTRY  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 5)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    out = [tuple(norm(r[k]) for k in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, sf_dir, name):
    q = REGISTRY[name]
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t0
    if q.sql is None:
        return "rows-only", len(srows), ts, ""
    t1 = time.time()
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t1
    if sorted(scols) != sorted(dcols):
        return "COLS", len(srows), ts, f"spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return "COUNT", len(srows), ts, f"spark={len(srows)} duck={len(drows)}"
    a, b = canon(srows, scols), canon(drows, dcols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return "VALUES", len(srows), ts, str(diff)
    return "ok", len(srows), ts, f"duck {td:.1f}s"


def main():
    global EXACT
    args = sys.argv[1:]
    if "--exact" in args:  # floats must agree exactly (they are rounded to 6 places by the queries)
        EXACT = True
        args.remove("--exact")
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(REGISTRY)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            st, rows, ts, info = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and continue
            st, rows, ts, info = "ERROR", -1, 0.0, repr(e)[:400]
        bad += st not in ("ok", "rows-only")
        print(f"{st:9s} {n:32s} rows={rows:<8d} {ts:6.1f}s {info}", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")


if __name__ == "__main__":
    main()
