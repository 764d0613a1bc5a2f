"""Side-by-side check of a registered query against its DuckDB oracle.

Mimics the driver: same row count, same column names and types, and the same
multiset of rows (columns sorted by name, values compared exactly).

    python -m tests.harness [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT",
                  "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
                  "timestamp_ntz": "TIMESTAMP"}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _spark_type(dt) -> str:
    s = dt.simpleString()
    if s.startswith("decimal"):
        return s.upper().replace("DECIMAL", "DECIMAL")
    return _SPARK_TO_DUCK.get(s, s.upper())


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, decimal.Decimal):
        return v
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, name: str, sf_dir: str, spark_fn, sql: str) -> dict:
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck_connection(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = {}
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    for row in desc:
        d_types[row[0]] = str(row[1])
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["types_match"] = out["columns_match"] and all(
        s_types[c] == d_types.get(c) for c in s_cols)
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_cols) | set(d_cols)
                            if s_types.get(c) != d_types.get(c)}
    if out["columns_match"]:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sc = collections.Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
        dc = collections.Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
        out["values_match"] = sc == dc
        if not out["values_match"]:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            out["only_spark"] = [str(x) for x in only_s]
            out["only_oracle"] = [str(x) for x in only_d]
    else:
        out["values_match"] = False
        out["cols"] = (s_cols, d_cols)
    out["ok"] = (out["values_match"] and out["types_match"]
                 and out["spark_rows"] == out["oracle_rows"])
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from arrears.session import build_session
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    qs, os_ = queries(), oracle_sql()
    names = names or sorted(qs)
    spark = build_session("local[8]", 8)
    bad = 0
    for n in names:
        if n not in os_:
            t0 = time.time()
            rows = qs[n](spark, sf_dir).count()
            print({"name": n, "rows_only": rows, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, n, sf_dir, qs[n], os_[n])
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}" if bad else f"ALL OK ({len(names)})")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
