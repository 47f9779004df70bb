"""Type classification.

``type_family`` works on *declared type strings* and keeps the ordered
substring rule of the reference exactly, including its quirks: the first rule
that matches wins, so ``INTERVAL`` and ``POINT`` (they contain ``INT``) are
numeric, ``ARRAY<STRING>`` is text and ``STRUCT<a INT64>`` numeric.

``family_of_type`` works on Spark ``DataType`` objects and classifies by
structure instead (arrays, maps and structs are ``complex``, intervals are
``interval``). Use it when both sides are Spark schemas and the reference's
string quirks are not wanted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, CharType, DataType, DateType,
                               DayTimeIntervalType, DecimalType, FractionalType, IntegerType, IntegralType,
                               LongType, MapType, ShortType, StringType, StructType, TimestampNTZType,
                               TimestampType, VarcharType, YearMonthIntervalType)

from concord.functions.text import strip_ws

# Fixed values that must equal the reference's rule, in its order:
# (family, substrings of the upper-cased, trimmed declared type).
TYPE_FAMILY_RULES = (
    ("text", ("CHAR", "CLOB", "STRING", "TEXT", "VARCHAR")),
    ("temporal", ("DATE", "TIME", "TIMESTAMP", "DATETIME")),
    ("numeric", ("NUMBER", "NUMERIC", "DECIMAL", "INT", "FLOAT", "DOUBLE", "REAL", "BIGNUMERIC")),
    ("boolean", ("BOOL", "BOOLEAN")),
    ("bytes", ("BLOB", "BYTES", "RAW", "BINARY")),
    ("complex", ("STRUCT", "RECORD", "ARRAY")),
    ("json", ("JSON",)),
)

# Default (precision, scale) of target numeric type names.
NUMERIC_SHAPES = {"NUMERIC": (38, 9), "BIGNUMERIC": (76, 38), "INT64": (19, 0)}

# Decimal digits of Spark's integral types (precision, scale 0).
_INTEGRAL_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def type_family(raw_type: Column) -> Column:
    """A2: the family of a declared type string, as one JVM ``CASE`` expression."""
    norm = F.upper(strip_ws(raw_type))
    expr = None
    for family, tokens in TYPE_FAMILY_RULES:
        cond = None
        for t in tokens:
            c = F.instr(norm, t) > 0
            cond = c if cond is None else cond | c
        expr = F.when(cond, F.lit(family)) if expr is None else expr.when(cond, F.lit(family))
    rest = F.lower(norm)
    return expr.otherwise(F.when(rest == "", F.lit("unknown")).otherwise(rest))


def family_of_type(dt: DataType) -> str:
    """Structural family of a Spark type."""
    if isinstance(dt, (StringType, CharType, VarcharType)):
        return "text"
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return "temporal"
    if isinstance(dt, (IntegralType, FractionalType, DecimalType)):
        return "numeric"
    if isinstance(dt, BooleanType):
        return "boolean"
    if isinstance(dt, BinaryType):
        return "bytes"
    if isinstance(dt, (ArrayType, MapType, StructType)):
        return "complex"
    if isinstance(dt, (DayTimeIntervalType, YearMonthIntervalType)):
        return "interval"
    return dt.simpleString()


def declared_type(dt: DataType) -> str:
    """The declared type string of a Spark type, upper-cased (``BIGINT``, ``DECIMAL(12,2)``)."""
    return dt.simpleString().upper()


def numeric_shape(dt: DataType) -> tuple[int | None, int | None]:
    """(precision, scale) of a Spark type: decimals as declared, integral types by digits."""
    if isinstance(dt, DecimalType):
        return dt.precision, dt.scale
    for cls, digits in _INTEGRAL_DIGITS.items():
        if isinstance(dt, cls):
            return digits, 0
    return None, None


def numeric_shape_of_name(raw_type: str) -> tuple[int | None, int | None]:
    """A3: default shape of a target numeric type name; unknown names give (None, None)."""
    return NUMERIC_SHAPES.get((raw_type or "").upper(), (None, None))


def char_length(dt: DataType) -> int | None:
    """Declared length of ``CHAR(n)``/``VARCHAR(n)``; plain strings have none."""
    if isinstance(dt, (CharType, VarcharType)):
        return dt.length
    return None


def loader_type_name(dt: DataType) -> str:
    """The loader's type name for a source column (integers load as FLOAT64, as in the reference)."""
    if isinstance(dt, (TimestampType, TimestampNTZType, DateType)):
        return "DATETIME"
    if isinstance(dt, BooleanType):
        return "BOOL"
    if isinstance(dt, (IntegralType, FractionalType, DecimalType)):
        return "FLOAT64"
    return "STRING"
