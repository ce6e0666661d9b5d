"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names, column types and sorted row values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, key, sf_dir, query_fn, sql, con):
    t0 = time.time()
    sdf = query_fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_names = sdf.columns
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields]
    t0 = time.time()
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    t_duck = time.time() - t0
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns spark={sorted(s_names)} duck={sorted(d_names)}")
    else:
        st = dict(zip(s_names, s_types))
        dtp = dict(zip(d_names, d_types))
        bad = {c: (st[c], dtp[c]) for c in s_names if st[c] != dtp[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif not problems:
        a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
        if a != b:
            diffs = [(x, y) for x, y in zip(a, b) if x != y]
            problems.append(f"values differ in {len(diffs)} rows, e.g. {diffs[:2]}")
    return problems, len(s_rows), t_spark, t_duck


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from weekcast.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    keys = keys or list(qs)
    failed = 0
    for k in keys:
        if k not in sqls:
            n = qs[k](spark, sf_dir).count()
            print(f"-- {k:32s} rows-only {n}")
            continue
        try:
            problems, n, ts, td = compare(spark, k, sf_dir, qs[k], sqls[k], con)
        except Exception as e:  # noqa: BLE001
            problems, n, ts, td = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        status = "OK " if not problems else "BAD"
        failed += bool(problems)
        print(f"{status} {k:32s} rows={n:<7d} spark={ts:5.1f}s duck={td:5.1f}s {'; '.join(problems)}", flush=True)
    print(f"failed {failed} of {len(keys)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
