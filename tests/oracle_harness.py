"""Run a registered Spark query and its DuckDB oracle on the same Parquet tables and
compare them order-insensitively (column names, row count, values).

CLI:  python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):  # numpy scalar
        return _norm(v.item())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, records):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark_rows: list[dict], spark_cols: list[str], duck_rows: list[dict], duck_cols: list[str],
            rel_tol: float = 0.0):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    cols = sorted(spark_cols)
    a, b = _rows(cols, spark_rows), _rows(cols, duck_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    bad = 0
    first = None
    for x, y in zip(a, b):
        for c, u, v in zip(cols, x, y):
            same = u == v
            if not same and isinstance(u, (int, float)) and isinstance(v, (int, float)):
                same = math.isclose(u, v, rel_tol=rel_tol, abs_tol=0.0) if rel_tol else False
            if not same:
                bad += 1
                first = first or (c, u, v)
    if bad:
        return False, f"{bad} values differ, first {first}"
    return True, f"{len(a)} rows"


def check(spark, sf_dir: str, keys=None, con=None, verbose=True):
    from bramble.plans.registry import ORACLE_SQL, QUERIES
    con = con or duck(sf_dir)
    results = {}
    for k in keys or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[k](spark, sf_dir)
            srows = [r.asDict() for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[k] = (False, f"spark error {type(e).__name__}: {str(e)[:300]}")
            print(k, results[k]) if verbose else None
            continue
        t1 = time.time()
        sql = ORACLE_SQL.get(k)
        if sql is None:
            results[k] = (True, f"no oracle; {len(srows)} rows")
        else:
            try:
                rel = con.execute(sql)
                dcols = [d[0] for d in rel.description]
                drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
                results[k] = compare(srows, scols, drows, dcols)
            except Exception as e:  # noqa: BLE001
                results[k] = (False, f"duck error {type(e).__name__}: {str(e)[:300]}")
        if verbose:
            print(f"{k:34s} {'OK ' if results[k][0] else 'BAD'} {results[k][1]}  [{t1 - t0:.1f}s]", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from bramble.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf, keys)
    ok = sum(1 for v in res.values() if v[0])
    print(f"{ok}/{len(res)} ok")
