"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison as the driver does it: row count, column names, and an
order-insensitive hash of the values with columns sorted by name.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "asDict"):
        return {k: _norm(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in v.items()}
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str, ensure_ascii=False) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, limit_sec=300):
    import threading

    def cancel():
        spark.sparkContext.cancelAllJobs()
        con.interrupt()
    timer = threading.Timer(limit_sec, cancel)
    timer.start()
    try:
        return _compare(spark, con, name, fn, sql, sf_dir)
    finally:
        timer.cancel()


def _compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(d_rows)
    sh, sl = digest(s_cols, s_rows)
    dh, dl = digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and sh == dh
    res["status"] = "match" if ok else "MISMATCH"
    if not ok:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        only_s = sorted(set(sl) - set(dl))[:2]
        only_d = sorted(set(dl) - set(sl))[:2]
        res["spark_only"], res["duck_only"] = [x[:300] for x in only_s], [x[:300] for x in only_d]
    return res


def main(argv):
    from palimpsest.plans.catalog import REGISTRY
    from palimpsest.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(REGISTRY)
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.ui.showConsoleProgress": "false"})
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        fn, sql = REGISTRY[n]
        try:
            r = compare(spark, con, n, fn, sql, sf_dir, int(os.environ.get("ORACLE_LIMIT_SEC", "300")))
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": str(e).splitlines()[0][:400]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(json.dumps(r, ensure_ascii=False), flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
