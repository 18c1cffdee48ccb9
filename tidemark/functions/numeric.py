"""Rounding and flag arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round the binary value to ``digits`` decimals, ties away from zero.

    Spark's own ``round`` works on the shortest decimal text (1.005 -> 1.01) and
    goes through BigDecimal. Here the double itself is scaled and rounded, so
    1.005 -> 1.0, and the expression stays primitive in generated code. ``rint``
    rounds ties to even; the correction moves exactly those ties outwards.
    """
    scale = float(10**digits)
    scaled = value.cast("double") * F.lit(scale)
    even = F.rint(scaled)
    sign = F.signum(scaled)
    tie_inwards = (scaled - even) == sign * F.lit(0.5)
    return (even + F.when(tie_inwards, sign).otherwise(F.lit(0.0))) / F.lit(scale)


def flag_as_double(flag: Column) -> Column:
    """1.0 for true, 0.0 for false and for null."""
    return F.coalesce(flag.cast("double"), F.lit(0.0))


def count_true(condition: Column) -> Column:
    """Number of rows where the condition is true; null is not true."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def whole_division(value: Column, by: int) -> Column:
    """Integer quotient of a non-negative whole number, exact at any size."""
    return F.call_function("div", value, F.lit(by)).cast("bigint")
