"""Counts and sums of attempts per segment, from one scan, that loads can be merged into.

A summary row holds what counts, sums and means are made of, never a rate: rows of several loads add up, and
every mart is a roll-up of them that equals the mart built from the attempts themselves. The keys have
small domains, so a summary has a few thousand rows however many attempts there are.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.schema import LABEL, MART_MIN_ATTEMPTS

KEYS = ["city", "address_type", "delivery_window", "has_delivery_preference", "proximity_alert_sent"]
#: All attempts, those with an outcome, the successful ones; those with a value and the values' sum.
STATES = ["attempts", "rated", "successful", "valued", "order_value"]


def summarise(df: DataFrame) -> DataFrame:
    """One row per segment, NULL being a key of its own."""
    return df.groupBy(*KEYS).agg(
        F.count("*").alias("attempts"),
        F.count(LABEL).alias("rated"),
        F.coalesce(F.sum(LABEL), F.lit(0)).cast("long").alias("successful"),
        F.count("order_value").alias("valued"),
        F.coalesce(F.sum("order_value"), F.lit(0.0)).cast("double").alias("order_value"),
    )


def roll_up(summary: DataFrame, *keys: str) -> DataFrame:
    """The summary by fewer keys, or of everything without any."""
    return summary.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in STATES])


def merge(*summaries: DataFrame) -> DataFrame:
    """The summary of all loads together; each attempt must be in one of them only."""
    return roll_up(reduce(DataFrame.unionByName, summaries), *KEYS)


def _fraction(part: Column | str) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    return F.try_divide(part.cast("double"), F.col("rated"))


def fadr_by(summary: DataFrame, *keys: str, digits: int = 2) -> DataFrame:
    """Attempts and success rate in percent by some of the keys."""
    return roll_up(summary, *keys).select(
        *keys, F.col("attempts").alias("total_attempts"), F.round(_fraction("successful") * 100, digits).alias("fadr_pct")
    )


def fadr_by_segment(summary: DataFrame) -> DataFrame:
    """As :func:`doorstep.operators.marts.fadr_by_segment`."""
    keyed = summary.where(F.col("city").isNotNull() & F.col("address_type").isNotNull())
    return roll_up(keyed, "city", "address_type").select(
        "city",
        "address_type",
        F.col("rated").alias("total_attempts"),
        "successful",
        _fraction("successful").alias("fadr"),
    )


def mart_city_address(summary: DataFrame) -> DataFrame:
    """As :func:`doorstep.operators.marts.mart_city_address`; the mean value may differ in its last digit."""
    return roll_up(summary, "city", "address_type").select(
        "city",
        "address_type",
        F.col("attempts").alias("total_attempts"),
        F.when(F.col("rated") > 0, F.col("successful")).alias("successful_deliveries"),
        F.round(_fraction("successful"), 4).alias("fadr"),
        F.round(_fraction(F.col("rated") - F.col("successful")), 4).alias("failure_rate"),
        F.try_divide(F.col("order_value"), F.col("valued")).alias("avg_order_value"),
    )


def mart_window_alerts(summary: DataFrame, *, min_attempts: int = MART_MIN_ATTEMPTS) -> DataFrame:
    """As :func:`doorstep.operators.marts.mart_window_alerts`."""
    keys = ["delivery_window", "address_type", "has_delivery_preference", "proximity_alert_sent"]
    return (
        roll_up(summary, *keys)
        .where(F.col("attempts") > min_attempts)
        .select(*keys, F.col("attempts").alias("total_attempts"), F.round(_fraction("successful"), 4).alias("fadr"))
    )
