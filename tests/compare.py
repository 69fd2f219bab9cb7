"""Spark-vs-DuckDB comparison used by the oracle tests and ``tools``.

Mirrors the driver's gate: same column names (sorted), same row count, and the
same multiset of rows (order-insensitive).  Doubles are compared after rounding
to 9 significant digits so that summation-order noise does not count.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("BIKELAKE_STRICT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if STRICT else float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(rows, key=_key)


def compare(df, con, sql):
    """Return (ok, message)."""
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count differs: spark={len(srows)} duck={len(drows)}"
    if srows != drows:
        for a, b in zip(srows, drows):
            if a != b:
                return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(srows)} rows"


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP"}


def type_diffs(df, con, sql):
    """Columns whose Spark type does not map to the DuckDB result type."""
    dtypes = dict(df.dtypes)
    rel = con.sql(sql)
    out = []
    for name, t in zip(rel.columns, rel.types):
        st = dtypes.get(name)
        if st is None:
            continue
        if SPARK_TO_DUCK.get(st, st.upper()) != str(t):
            out.append(f"{name}: spark={st} duck={t}")
    return out
