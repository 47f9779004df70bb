"""Compare a Spark result with a DuckDB query over the same parquet tables.

Mirrors the driver's gate: same column names, same row count, and the same
multiset of rows (columns sorted by name, order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return v.normalize() if v == v else "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sn, sr = rows_of(s_names, s_rows)
    dn, dr = rows_of(d_names, d_rows)
    if sn != dn:
        return f"columns differ: spark={sn} duckdb={dn}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"row differs: spark={a} duckdb={b}"
    return None


def spark_type_name(dt) -> str:
    """The DuckDB name of a Spark result type, for schema comparison."""
    from pyspark.sql import types as T
    simple = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
              T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN",
              T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
              T.BinaryType: "BLOB"}
    for cls, name in simple.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return dt.simpleString().upper()


def type_mismatches(spark_df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in spark_df.schema.fields:
        want = duck_types.get(f.name)
        got = spark_type_name(f.dataType)
        if want is not None and want != got:
            out.append(f"{f.name}: spark {got} vs duckdb {want}")
    return out
