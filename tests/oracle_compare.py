"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``.  Prints one
line per key: rows, column match, exact value match, tolerant match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, tolerant: bool):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if tolerant:
            return f"{v:.9g}"
        return repr(v)
    if isinstance(v, int):
        return repr(float(v)) if tolerant else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, tolerant) for x in v) + "]"
    return str(v)


def canon(columns, rows, tolerant=False):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i], tolerant) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    elapsed = time.time() - t0
    if sql is None:
        return dict(name=name, rows=len(s_rows), oracle_rows=None, cols=True, exact=None, approx=None, sec=elapsed)
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    cols_ok = sorted(s_cols) == sorted(d_cols)
    exact = cols_ok and canon(s_cols, s_rows) == canon(d_cols, d_rows)
    approx = cols_ok and canon(s_cols, s_rows, True) == canon(d_cols, d_rows, True)
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), cols=cols_ok, exact=exact, approx=approx, sec=elapsed)
    if not cols_ok:
        out["detail"] = f"spark={sorted(s_cols)} oracle={sorted(d_cols)}"
    elif not exact:
        a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
        diff = [x for x in a if x not in set(b)][:2]
        diff2 = [x for x in b if x not in set(a)][:2]
        out["detail"] = f"spark-only={diff} oracle-only={diff2}"
    return out


def main(argv):
    plain = "--plain-session" in argv
    argv = [a for a in argv if a != "--plain-session"]
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not os.path.isdir(a)]
    if plain:
        # what a driver might build: no time zone pin, no checkpoint folder
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        from cataloom.session import build_session

        spark = build_session(master="local[8]", checkpoint_dir=tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    import __spark_entry__ as entry

    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in keys or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = dict(name=name, error=f"{type(exc).__name__}: {str(exc)[:300]}")
        status = "ERROR" if "error" in r else ("rows-only" if r["exact"] is None else
                 ("OK" if r["exact"] and r["rows"] == r["oracle_rows"] else ("APPROX" if r["approx"] else "MISMATCH")))
        bad += status in ("ERROR", "MISMATCH")
        print(f"{status:9s} {name:32s} {r.get('rows')}/{r.get('oracle_rows')} {r.get('sec', 0):.1f}s {r.get('detail', r.get('error', ''))}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
