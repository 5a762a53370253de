"""Local replica of the driver's check: Spark query vs DuckDB oracle."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, np.ndarray):
        return tuple(norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if v is pd.NaT:
        return None
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "double": "DOUBLE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "date": "DATE"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    st = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = [(c, st[c], dt.get(c)) for c in st if SPARK_TO_DUCK.get(st[c], st[c]) != dt.get(c)]
    if bad:
        return False, f"column types differ: {bad}"
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count {len(s)} vs {len(o)}"
    rs, ro = rows(s), rows(o)
    for a, b in zip(rs, ro):
        if a != b:
            return False, f"first diff:\n spark={repr(a)[:600]}\n duck ={repr(b)[:600]}"
    return True, f"{len(s)} rows"
