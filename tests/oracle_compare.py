"""Run registered queries in Spark and their DuckDB oracle; compare the results.

Usable from pytest and as a script:
    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
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
        return float(repr(v))
    if hasattr(v, "isoformat"):
        return str(v)[:23]
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(rel):
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], out


def compare(spark, sf_dir: str, keys=None, con=None):
    import __spark_entry__ as entry

    qs = entry.queries()
    oracle = entry.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            scols, srows = rows_of_spark(qs[k](spark, sf_dir))
        except Exception as e:  # pragma: no cover - reported
            results[k] = ("spark-error", repr(e)[:500])
            continue
        t1 = time.time()
        if k not in oracle:
            results[k] = ("no-oracle", len(srows))
            continue
        try:
            dcols, drows = rows_of_duck(con.sql(oracle[k]))
        except Exception as e:  # pragma: no cover - reported
            results[k] = ("duck-error", repr(e)[:500])
            continue
        if scols != dcols:
            results[k] = ("columns", scols, dcols)
            continue
        cs, cd = Counter(srows), Counter(drows)
        if cs == cd:
            results[k] = ("ok", len(srows), round(t1 - t0, 2))
        else:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            results[k] = ("diff", len(srows), len(drows), only_s, only_d)
    return results


if __name__ == "__main__":
    from listenlab.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session(8)
    res = compare(spark, sf, keys)
    bad = 0
    for k, v in res.items():
        if v[0] != "ok":
            bad += 1
        print(k, *v)
    print("FAILED" if bad else "ALL OK", bad)
