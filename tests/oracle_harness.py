"""Compare a registered Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive comparison of values
(columns sorted by name, doubles compared at 6 decimals, value types strict).

CLI:  python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("null",)
        return ("f", round(v, 6) + 0.0)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, decimal.Decimal):
        return ("f", round(float(v), 6))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("a", tuple(_norm(x) for x in v))
    return ("s", str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return cols, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark, con, key, query, sql, sf):
    t0 = time.time()
    scols, srows = spark_rows(query(spark, sf))
    t1 = time.time()
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    dcols, drows = duck_rows(con, sql)
    res["oracle_rows"] = len(drows)
    problems = []
    if scols != dcols:
        problems.append(f"columns spark={scols} oracle={dcols}")
    if len(srows) != len(drows):
        problems.append("row count")
    if not problems:
        a, b = sorted(srows, key=repr), sorted(drows, key=repr)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    res["status"] = "ok" if not problems else "MISMATCH: " + "; ".join(problems)
    return res


def main(argv):
    sf = argv[0] if argv and os.path.isdir(argv[0]) else "/root/testdata/sf0.01"
    keys = [a for a in argv if not os.path.isdir(a)]
    from hourwise.session import build_session
    import __spark_entry__ as E

    spark = build_session(os.environ.get("HARNESS_MASTER", "local[8]"))
    con = duck(sf)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        try:
            r = compare(spark, con, k, qs[k], os_.get(k), sf)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += not (r["status"] in ("ok", "rows-only"))
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} passed, {bad} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
