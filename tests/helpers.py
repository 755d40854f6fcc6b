"""Comparison helpers shared by the tests and tools/check_oracle.py."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (bool, int)):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_family(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    return {"int": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8", "double": "float64",
            "float": "float32", "string": "string", "boolean": "bool", "date": "date",
            "timestamp_ntz": "timestamp", "timestamp": "timestamp_tz"}.get(t, t)


def duck_family(t) -> str:
    t = str(t).upper()
    if t.startswith("DECIMAL"):
        return "decimal"
    return {"INTEGER": "int32", "BIGINT": "int64", "HUGEINT": "int128", "SMALLINT": "int16", "TINYINT": "int8",
            "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date",
            "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp_tz"}.get(t, t)
