"""Null-safe join keys that keep the aggregate's partitioning.

A ``<=>`` join is planned on ``coalesce(key, ·)`` / ``isnull(key)``
expressions, which do not match the hash partitioning of an aggregate grouped
by ``key``, so Spark shuffles the aggregated rows again. Grouping by the pair
``(isnull(key), coalesce(key, default))`` instead, and joining on those two
columns with plain equality, gives the same null-safe semantics with the join
reusing the aggregate's partitioning (no extra exchange).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DataType, DateType, NumericType, StringType,
                               TimestampNTZType, TimestampType)


def _default(dtype: DataType) -> Column | None:
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, DateType):
        return F.lit(dt.date(1970, 1, 1))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    if isinstance(dtype, BinaryType):
        return F.lit(b"").cast("binary")
    return None


def split_keys(df: DataFrame, keys: Sequence[str]) -> tuple[list[Column], list[str]]:
    """Grouping expressions ``_kn<j>``/``_kv<j>`` (or the raw key when no default exists) and their names."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs, names = [], []
    for j, k in enumerate(keys):
        d = _default(types[k])
        if d is None:
            exprs.append(F.col(k).alias(f"_kr{j}"))
            names.append(f"_kr{j}")
        else:
            exprs += [F.isnull(F.col(k)).alias(f"_kn{j}"), F.coalesce(F.col(k), d).alias(f"_kv{j}")]
            names += [f"_kn{j}", f"_kv{j}"]
    return exprs, names


def restore_key(j: int, names: Sequence[str], prefix: str = "") -> Column:
    """The original key value from its split columns."""
    if f"_kr{j}" in names:
        return F.col(f"{prefix}_kr{j}")
    return F.when(F.col(f"{prefix}_kn{j}"), F.lit(None)).otherwise(F.col(f"{prefix}_kv{j}"))


def join_condition(names: Sequence[str], left: str, right: str) -> Column:
    cond = None
    for n in names:
        c = (F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) if n.startswith("_kr")
             else F.col(f"{left}.{n}") == F.col(f"{right}.{n}"))
        cond = c if cond is None else cond & c
    return cond
