"""The additive success rule as a scoring column."""

from pyspark.sql import Column, functions as F

from doorstep.functions.labels import lookup
from doorstep.schema import (
    ADDRESS_BP,
    BASE_BP,
    HIGH_VALUE,
    HIGH_VALUE_BP,
    MAX_BP,
    MIN_BP,
    WINDOW_BP,
)


def expected_success_bp(
    address: str = "address_type",
    window: str = "delivery_window",
    value: str = "order_value",
) -> Column:
    """Rule-based success chance in whole basis points, so sums and clamps are exact."""
    points = (
        F.lit(BASE_BP)
        + lookup(address, ADDRESS_BP, 0)
        + lookup(window, WINDOW_BP, 0)
        + F.when(F.col(value) > HIGH_VALUE, HIGH_VALUE_BP).otherwise(0)
    )
    return F.least(F.lit(MAX_BP), F.greatest(F.lit(MIN_BP), points))


def expected_success_prob(**columns: str) -> Column:
    return expected_success_bp(**columns) / F.lit(10000.0)
