"""Spark result vs DuckDB oracle: row count, column names and an
order-insensitive hash of the values (floats rounded)."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    try:
        import numpy as np
        if isinstance(v, np.ndarray):
            return "[" + ",".join(_norm(x) for x in v.tolist()) + "]"
        if isinstance(v, np.floating):
            return _norm(float(v))
        if isinstance(v, np.integer):
            return str(int(v))
    except Exception:
        pass
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(rows: list[tuple], cols: list[str]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
               for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    res = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_rows, s_cols) == digest(d_rows, d_cols),
    }
    res["types_match"] = s_types == d_types
    if not res["types_match"]:
        res["types"] = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
    res["ok"] = res["cols_match"] and res["hash_match"] and len(s_rows) == len(d_rows)
    if not res["cols_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    if not res["ok"] and res["cols_match"]:
        order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        dorder = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = set("|".join(_norm(r[i]) for i in order) for r in s_rows)
        b = set("|".join(_norm(r[i]) for i in dorder) for r in d_rows)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_oracle"] = sorted(b - a)[:3]
    return res
