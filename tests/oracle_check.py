"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name, floats rounded to 9 places), as the driver's
check does.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, int):
        return int(v)
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return [columns[i] for i in order], h.hexdigest()


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    df = build(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    s_cols, s_hash = digest(df.columns, s_rows)
    t0 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t_duck = time.time() - t0
    d_cols_sorted, d_hash = digest(d_cols, d_rows)
    return {
        "name": name, "rows": (len(s_rows), len(d_rows)),
        "cols_ok": s_cols == d_cols_sorted, "hash_ok": s_hash == d_hash,
        "rows_ok": len(s_rows) == len(d_rows),
        "spark_s": round(t_spark, 2), "duck_s": round(t_duck, 2),
        "cols": (s_cols, d_cols_sorted),
    }


def main(argv):
    import __spark_entry__ as E
    from sparkcount.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:34s} no oracle")
            continue
        r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        ok = r["rows_ok"] and r["cols_ok"] and r["hash_ok"]
        bad += not ok
        print(f"{name:34s} {'OK ' if ok else 'BAD'} rows={r['rows']} spark={r['spark_s']}s "
              f"duck={r['duck_s']}s" + ("" if r["cols_ok"] else f" cols={r['cols']}"), flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
