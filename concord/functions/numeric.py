"""Numeric helpers shared by reconciliation and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType

# Sums are carried as decimal(38,6): exact, independent of summation order and
# of the engine, and the same six decimals the reference rounds to.
SUM_TYPE = "decimal(38,6)"

# Values from here on are not summed but counted and hashed (``special_values``):
# below it, ten billion values of one group still fit the sum.
SUM_LIMIT = 1e22

# What a value that cannot be summed is reported as, in the order of the struct.
SPECIAL_CHECKS = ("nan", "positive_infinity", "negative_infinity", "out_of_range")


def always_summable(dtype: DataType | None) -> bool:
    """Whether every value of the type is below ``SUM_LIMIT``."""
    return isinstance(dtype, IntegralType) or isinstance(dtype, DecimalType) and dtype.precision - dtype.scale <= 22


def as_exact(c: Column, dtype: DataType | None = None) -> Column:
    """A value at the fixed sum scale; NULL for NULL, NaN, infinities and values from ``SUM_LIMIT`` on."""
    if always_summable(dtype):
        return c.cast(SUM_TYPE)
    return F.when(F.abs(c.cast("double")) < F.lit(SUM_LIMIT), c.try_cast(SUM_TYPE))


def exact_sum(c: Column, dtype: DataType | None = None) -> Column:
    """``SUM`` of the summable values at decimal(38,6): 0 without any, NULL if even the sum overflows.

    What is left out here is counted by ``special_values``; a comparison looks at both.
    """
    zero = F.lit(0).cast(SUM_TYPE)
    v = as_exact(c, dtype)
    return F.when(F.count(v) == 0, zero).otherwise(F.try_sum(v))


def identity(c: Column, dtype: DataType) -> list[Column]:
    """Doubles that together identify an exact number whatever numeric type holds it.

    The nearest double, and for types that hold more digits what it leaves over (twice, for 38 digits):
    a bigint, a decimal of any scale and a double of equal value give equal lists. -0.0 is 0.0, all NaN are one.
    """
    d = c.cast("double")
    d = F.when(F.isnan(d), F.lit(float("nan"))).when(d == 0, F.lit(0.0)).otherwise(d)
    none = F.lit(0.0)
    if isinstance(dtype, LongType):
        wide, rest = "decimal(38,0)", 1
    elif isinstance(dtype, DecimalType):
        wide, rest = f"decimal(38,{dtype.scale})", 2
    else:
        return [d, none, none]
    left, out = c.cast(wide), [d]
    for _ in range(rest):
        left = left - out[-1].try_cast(wide)
        step = F.coalesce(left.cast("double"), F.lit(0.0))
        out.append(F.when(step == 0, none).otherwise(step))
    return out + [none] * (2 - rest)


def special_values(c: Column, dtype: DataType) -> Column:
    """Counts of NaN, +Infinity, -Infinity and out-of-range values of a group, and a sum of hashes of the latter."""
    if always_summable(dtype):
        return F.struct(*[F.lit(0).cast("bigint").alias(k) for k in SPECIAL_CHECKS], F.lit(0).cast("decimal(38,0)").alias("digest"))
    d = c.cast("double")
    big = (F.abs(d) >= F.lit(SUM_LIMIT)) & (F.abs(d) < F.lit(float("inf")))
    digest = F.xxhash64(*identity(c, dtype)).cast("decimal(20,0)")
    return F.struct(F.count_if(F.isnan(d)).alias("nan"), F.count_if(d == F.lit(float("inf"))).alias("positive_infinity"),
                    F.count_if(d == F.lit(float("-inf"))).alias("negative_infinity"), F.count_if(big).alias("out_of_range"),
                    F.coalesce(F.sum(F.when(big, digest)), F.lit(0)).cast("decimal(38,0)").alias("digest"))


def add_special(c: str) -> Column:
    """The special values of several groups together."""
    total = lambda f: F.coalesce(F.sum(f"{c}.{f}"), F.lit(0))
    return F.struct(*[total(f).alias(f) for f in SPECIAL_CHECKS], total("digest").cast("decimal(38,0)").alias("digest"))


def within_tolerance(a: Column, b: Column, tol: float) -> Column:
    """``isclose(a, b, rel_tol=tol, abs_tol=tol)``; NULL on either side is not close."""
    diff = F.abs(a - b)
    bound = F.greatest(F.lit(tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(tol))
    return F.coalesce(diff <= bound, F.lit(False))
