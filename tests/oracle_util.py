"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for v in TABLES:
        p = f"{sf_dir}/{v}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)  # keeps the scale: types must agree too
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def spark_types(df):
    return {c: (t.upper() if t.startswith("decimal") else SPARK_TO_DUCK.get(t, t)) for c, t in df.dtypes}


def duck_types(con, sql):
    return {d[0]: str(d[1]) for d in con.execute(sql).description}


def spark_canon(df):
    return canon(df.columns, [tuple(r) for r in df.collect()])


def duck_canon(con, sql):
    cur = con.execute(sql)
    return canon([d[0] for d in cur.description], cur.fetchall())
