"""Rounding and number helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round the way the region report does: scale, round to whole, scale back.

    ``F.round`` rounds the decimal digits of a double instead, which differs for
    values such as 284.405 whose binary form lies below the tie.
    """
    if digits == 0:
        return F.round(value, 0)
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded, and 0 when there is nothing to divide by."""
    return F.coalesce(F.round(F.try_divide(part, whole), digits), F.lit(0.0))


# Digits kept when measures are added up exactly, and when their means are.
SUMMED, AVERAGED = "decimal(24,9)", "decimal(27,12)"


def exact_part(value: Column, digits: str = SUMMED) -> Column:
    """A double as the decimal it is written as; null where a decimal can't hold it."""
    return F.when(~F.isnan(value), value.cast("double").try_cast(digits))


def inexact_part(value: Column, digits: str = SUMMED) -> Column:
    """What ``exact_part`` leaves out: NaN, infinite and very large values."""
    return F.when(exact_part(value, digits).isNull(), value.cast("double"))


def exact_mean(total: Column, rest: Column, n: Column) -> Column:
    """The mean as a double from an exact sum, the sum of the rest and a count; null for none."""
    quotient = F.try_divide(total, n.cast("decimal(19,0)")).cast("double")
    whole = F.coalesce(total, F.lit(0)).cast("double")
    return F.when(rest.isNull(), quotient).otherwise(F.try_divide(whole + rest, n))


def round_mean(value: Column, digits: int) -> Column:
    """An aggregate: the mean of ``value`` rounded by scaling, the same in any order of rows.

    Values are added up as decimals. A mean that equals a tie to nine decimals counts as
    the tie, as quotients such as 1/3 have no finite form, and rounds as its double does.
    """
    mean = exact_mean(
        F.sum(exact_part(value, AVERAGED)), F.sum(inexact_part(value, AVERAGED)), F.count(value)
    )
    nearest = F.coalesce(exact_part(mean).cast("double"), mean)
    return round_scaled(nearest, digits)
