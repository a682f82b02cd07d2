"""Run registered Spark queries against their DuckDB oracle SQL and compare
row count, column names and the multiset of row values (exact)."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _spark_family(t: str) -> str:
    return {
        "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "float64",
        "float": "float32", "string": "string", "boolean": "bool", "date": "date", "timestamp": "timestamp",
        "timestamp_ntz": "timestamp",
    }.get(t, t)


def _duck_family(t: str) -> str:
    t = t.upper()
    return {
        "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
        "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
        "NUMBER": "number", "STRING": "string", "DATETIME": "timestamp",
    }.get(t, t)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as e

    df = e.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_recs = [tuple(r) for r in df.collect()]
    sql = e.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(s_recs)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_recs = cur.fetchall()
    res["duck_rows"] = len(d_recs)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    s_types = {f.name: _spark_family(f.dataType.simpleString()) for f in df.schema.fields}
    d_types = {c[0]: _duck_family(str(c[1])) for c in cur.description}
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    if bad_types:
        res["types"] = bad_types
    a, b = _rows(s_cols, s_recs), _rows(d_cols, d_recs)
    if a == b:
        res["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "values differ"
        res["only_spark"] = list(sa - sb)[:3]
        res["only_duck"] = list(sb - sa)[:3]
        res["cols"] = sorted(s_cols)
    return res


if __name__ == "__main__":
    from tessera.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("oracle-check", master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as e

    con = duck(sf)
    bad = 0
    for n in names or list(e.queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as exc:  # noqa: BLE001
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("mismatches:", bad)
