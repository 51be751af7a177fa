"""Compare a Spark query with its DuckDB oracle: rows, column names, values.

Values are compared as an order-insensitive multiset of rows with columns
sorted by name; floats must match exactly (``exact``) or to 9 significant
digits (``close``).
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math

import duckdb

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{digits}g}") if digits else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _rows(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
        return out
    out["exact"] = _rows(s_cols, s_rows, None) == _rows(d_cols, d_rows, None)
    a, b = _rows(s_cols, s_rows, 9), _rows(d_cols, d_rows, 9)
    out["close"] = a == b
    if not out["close"]:
        out["sample_spark_only"] = list((a - b).elements())[:3]
        out["sample_oracle_only"] = list((b - a).elements())[:3]
    return out


def main(argv):
    """``python tests/oracle_check.py /root/testdata/sf0.01 [query ...]``"""
    import json
    import os
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from claimflow.session import get_session

    sf_dir, names = argv[0], argv[1:] or sorted(E.oracle_sql())
    spark = get_session("local[8]", shuffle_partitions=8)
    con, sqls, failures = duck(sf_dir), E.oracle_sql(), 0
    for name in names:
        t0 = time.time()
        try:
            r = compare(E.queries()[name](spark, sf_dir), con, sqls[name])
        except Exception as exc:  # report and go on with the next query
            r = {"error": repr(exc)[:500]}
        ok = bool(r.get("exact")) and r.get("spark_rows") == r.get("oracle_rows")
        failures += not ok
        print(("OK  " if ok else "BAD ") + name, f"{time.time() - t0:.1f}s",
              json.dumps(r, default=str)[:600], flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    import sys

    raise SystemExit(main(sys.argv[1:]))
