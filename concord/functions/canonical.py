"""Row hashes (R10): one identity per row that does not depend on how a side types its columns.

Values of a column are hashed in the form of the column's *common kind* on the two sides:

* numbers of any type by their exact value (``numeric.identity``): a bigint, a decimal of any scale
  and a double that hold the same number hash alike;
* dates and timestamps as timestamps without a zone (a date is its midnight);
* text, booleans and binary as they are; arrays, structs and maps only against the same type.

A column whose sides have no common kind cannot be compared; ``common_kind`` says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DateType, DecimalType, DoubleType,
                               FloatType, IntegralType, MapType, NumericType, StringType, StructType,
                               TimestampNTZType, TimestampType)

from concord.functions.numeric import identity


def _kind(dtype: DataType) -> str:
    for kind, types in (("text", StringType), ("number", NumericType), ("boolean", BooleanType),
                        ("time", (DateType, TimestampType, TimestampNTZType)), ("binary", BinaryType)):
        if isinstance(dtype, types):
            return kind
    return dtype.simpleString()


def common_kind(a: DataType, b: DataType) -> str | None:
    """The kind both types are compared as; None if there is no safe one."""
    if _kind(a) != _kind(b):
        return None
    integral, floating = isinstance(a, IntegralType) and isinstance(b, IntegralType), (DoubleType, FloatType)
    if _kind(a) == "number" and (integral or isinstance(a, floating) and isinstance(b, floating)):
        return "integer" if integral else "double"
    return _kind(a)


def shown_type(a: DataType, b: DataType) -> str:
    """The type in which a compared value is reported."""
    if a == b:
        return a.simpleString()
    kind = common_kind(a, b)
    if kind == "time":
        return "timestamp_ntz"
    if kind in ("integer", "double"):
        return "bigint" if kind == "integer" else "double"
    if kind == "number":
        if isinstance(a, (DoubleType, FloatType)) or isinstance(b, (DoubleType, FloatType)):
            return "double"
        return f"decimal(38,{max(getattr(t, 'scale', 0) for t in (a, b))})"
    return a.simpleString()


def hashable(c: Column, dtype: DataType, kind: str) -> list[Column]:
    if kind == "integer":
        return [c.cast("long")]
    if kind == "double":
        d = c.cast("double")
        return [F.when(F.isnan(d), F.lit(float("nan"))).when(d == 0, F.lit(0.0)).otherwise(d)]
    if kind == "number":
        return identity(c, dtype)
    if kind == "time":
        return [c.cast("timestamp_ntz")]
    if isinstance(dtype, MapType):
        return [F.to_json(F.array_sort(F.map_entries(c)))]
    if isinstance(dtype, (ArrayType, StructType)) and "map<" in dtype.simpleString():
        return [F.to_json(c)]
    return [c]


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``_h1``/``_h2``: two 64-bit xxhash64 values of the row (a 128-bit identity).

    ``kinds`` gives each column's common kind (default: the column's own). A null bitmap is hashed too,
    since xxhash64 skips NULLs and ``(NULL, x)`` would otherwise equal ``(x, NULL)``. ``_h2`` hashes the
    values in reverse order behind a salt, so the pair behaves as two independent hashes; one 64-bit hash
    alone would collide at ~10^12 rows.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    vals = [v for c in columns for v in hashable(F.col(c), types[c], (kinds or {}).get(c) or common_kind(types[c], types[c]))]
    masks = []
    for start in range(0, len(columns), 62):
        m = F.lit(0).cast("long")
        for i, c in enumerate(columns[start:start + 62]):
            m = m + F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        masks.append(m)
    return df.withColumn("_h1", F.xxhash64(*masks, *vals)).withColumn(
        "_h2", F.xxhash64(F.lit("concord/second"), *masks, *reversed(vals)))
