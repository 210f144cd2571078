"""Summary tables built from staged attempts."""

from pyspark.sql import DataFrame, functions as F

from doorstep.functions.rates import attempts, failure, success_fraction
from doorstep.schema import LABEL, MART_MIN_ATTEMPTS


def fadr_by_segment(df: DataFrame) -> DataFrame:
    """City and address segments with an unrounded success fraction.

    Rows with a NULL key belong to no segment, and only rated attempts are counted.
    """
    keyed = df.where(F.col("city").isNotNull() & F.col("address_type").isNotNull())
    return (
        keyed.groupBy("city", "address_type")
        .agg(
            F.count(LABEL).alias("total_attempts"),
            F.coalesce(F.sum(LABEL), F.lit(0)).alias("successful"),
        )
        .withColumn(
            "fadr",
            F.try_divide(F.col("successful").cast("double"), F.col("total_attempts")),
        )
    )


def mart_city_address(staged: DataFrame) -> DataFrame:
    return staged.groupBy("city", "address_type").agg(
        attempts().alias("total_attempts"),
        F.sum(LABEL).alias("successful_deliveries"),
        success_fraction().alias("fadr"),
        F.round(F.avg(failure()), 4).alias("failure_rate"),
        F.avg("order_value").alias("avg_order_value"),
    )


def mart_window_alerts(staged: DataFrame, *, min_attempts: int = MART_MIN_ATTEMPTS) -> DataFrame:
    """Segments by window, address, preference and alert with more than ``min_attempts`` rows."""
    segments = staged.groupBy(
        "delivery_window", "address_type", "has_delivery_preference", "proximity_alert_sent"
    ).agg(attempts().alias("total_attempts"), success_fraction().alias("fadr"))
    return segments.where(F.col("total_attempts") > min_attempts)
