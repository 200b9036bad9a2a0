"""Rounding, ratios and means that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(col: Column) -> Column:
    """Sum over count: with a DECIMAL input the sum is exact, and the quotient
    keeps more digits than ``avg`` does, so rounding it is safe."""
    return F.sum(col) / F.count(col)


def exact_mean(col: Column, digits: int = 12) -> Column:
    """Mean of a DOUBLE, the same whatever order the tasks finish in.

    Values that DECIMAL holds well are summed there. Very small, very large and
    special values are summed as DOUBLE beside them, so NaN and infinity make the
    mean what ``avg`` makes of it, and nothing overflows or is cut to zero.
    """
    size = F.abs(col)
    plain = ~F.isnan(col) & (size < 1e15) & ((size >= 1e-3) | (size == 0))
    exact = F.coalesce(F.sum(F.when(plain, col).cast(f"decimal({16 + digits},{digits})")).cast("double"), F.lit(0.0))
    rest = F.coalesce(F.sum(F.when(~plain, col)), F.lit(0.0))
    return F.try_divide(exact + rest, F.count(col))


def rounded(col: Column, digits: int) -> Column:
    return F.round(col, digits).cast("double")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100``, null when there is nothing to divide by."""
    return rounded(F.try_divide(part * F.lit(100.0), whole), digits)


def ratio_or_null(top: Column, bottom: Column) -> Column:
    """Division that yields null, not an error, on a zero divisor."""
    return F.try_divide(top, bottom)


def utilisation(on_trip: Column, total: Column) -> Column:
    return ratio_or_null(on_trip.cast("double"), total)


def gigabytes(size_bytes: Column) -> Column:
    return size_bytes / F.lit(1073741824.0)


def cost_per_gb(cost: Column, size_bytes: Column) -> Column:
    return ratio_or_null(cost, gigabytes(size_bytes))


def eps_per_dollar(eps: Column, cost_per_hour: Column) -> Column:
    """Null means free: there is no cost to divide by."""
    return ratio_or_null(eps, cost_per_hour)


def sink_decimal(col: Column, digits: int) -> Column:
    return F.round(col, digits).cast(f"decimal(18,{digits})")
