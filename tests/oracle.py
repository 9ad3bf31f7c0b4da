"""Side-by-side check of a registered query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values with columns sorted by name.
"""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, places):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, places) if places is not None else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, places) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, places)) for k, x in v.items()))
    return v


def rows_of(cols, records, places):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], places) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, name: str, fn, sql: str, sf_dir: str, places: int | None = 9):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_match"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        res["ok"] = False
        return res
    a, b = rows_of(s_cols, s_rows, None), rows_of(d_cols, d_rows, None)
    res["exact"] = a == b
    if not res["exact"]:
        a2, b2 = rows_of(s_cols, s_rows, places), rows_of(d_cols, d_rows, places)
        res["approx"] = a2 == b2
        diff = [(x, y) for x, y in zip(a2, b2) if x != y][:3]
        res["diff"] = diff
    res["ok"] = res["exact"] or res.get("approx", False)
    return res


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from logweave.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n, f in qs.items():
        if only and n not in only:
            continue
        if n not in sqls:
            df = f(spark, sf)
            print(f"{n}: rows-only {df.count()} cols={df.columns}", flush=True)
            continue
        try:
            r = compare(spark, n, f, sqls[n], sf)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:1500]}
        bad += not r["ok"]
        print(r, flush=True)
    print("BAD", bad)
