"""Aggregate expressions behind every success-rate report."""

from pyspark.sql import Column, functions as F

from doorstep.schema import LABEL


def attempts() -> Column:
    return F.count("*")


def success_percent(digits: int = 2, flag: str = LABEL) -> Column:
    """Success rate over all attempts, in percent."""
    return F.round(F.avg(flag) * 100, digits)


def success_fraction(digits: int = 4, flag: str = LABEL) -> Column:
    return F.round(F.avg(flag), digits)


def failure(flag: str = LABEL) -> Column:
    """Row-level failure indicator."""
    return F.lit(1) - F.col(flag)


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when there is no whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)
