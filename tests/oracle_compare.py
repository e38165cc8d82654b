"""Run catalogued queries on Spark and their oracle SQL on DuckDB and compare.

Mirrors the driver's check: row count, column names (sorted), and the
order-insensitive multiset of row values.  Usage:

    python -m tests.oracle_compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabula.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 2**53:
            return int(v)
        return repr(v)
    if isinstance(v, int):
        return v
    return str(v)


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows[tuple(_norm(x) for x in rec)] += 1
    return cols, rows


def compare(spark, con, name, sf_dir, fn, sql):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(sp), "spark_s": round(t1 - t0, 2)}
    dk = con.execute(sql).fetchdf()
    res = {"name": name, "spark_rows": len(sp), "duck_rows": len(dk), "spark_s": round(t1 - t0, 2)}
    sc, sr = canon(sp)
    dc, dr = canon(dk)
    if sc != dc:
        res["status"] = "schema"
        res["only_spark"] = sorted(set(sc) - set(dc))[:10]
        res["only_duck"] = sorted(set(dc) - set(sc))[:10]
        return res
    if sr == dr:
        res["status"] = "ok"
        return res
    res["status"] = "values"
    bad = []
    for i, c in enumerate(sc):
        a = Counter(r[i] for r in sr.elements())
        b = Counter(r[i] for r in dr.elements())
        if a != b:
            ex = list((a - b).items())[:2], list((b - a).items())[:2]
            bad.append((c, ex))
    res["bad_cols"] = bad[:8]
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tabula.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": "error", "err": str(e)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            failed += 1
        print(r, flush=True)
    print("FAILED", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
