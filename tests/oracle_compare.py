"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    sc, sv = canon(sdf.columns, srows)
    dc, dv = canon(list(rel.columns), drows)
    res["columns_match"] = sc == dc
    res["values_match"] = sv == dv
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
    elif not res["values_match"]:
        diff_s = [r for r in sv if r not in set(dv)][:3]
        diff_d = [r for r in dv if r not in set(sv)][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    return res


def main():
    from roadwatch.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    spark = build_session()
    con = duck(sf_dir)
    for n in names or list(E.queries()):
        try:
            print(compare(spark, n, sf_dir, con), flush=True)
        except Exception as e:  # report and continue
            print({"query": n, "error": repr(e)[:2000]}, flush=True)


if __name__ == "__main__":
    main()
