"""Ranking within a group."""

from pyspark.sql import DataFrame, Window, functions as F

from doorstep.functions.rates import success_percent


def worst_address_per_city(df: DataFrame) -> DataFrame:
    """The address type with the lowest rate in each city; ties on the rounded rate all stay.

    The window runs over one row per city and address type, never over attempts.
    """
    return worst_in_each_city(df.groupBy("city", "address_type").agg(success_percent().alias("fadr_pct")))


def worst_in_each_city(segments: DataFrame) -> DataFrame:
    """The rows of the lowest ``fadr_pct`` in each city."""
    by_rate = Window.partitionBy("city").orderBy("fadr_pct")
    return (
        segments.withColumn("rank_in_city", F.rank().over(by_rate))
        .where(F.col("rank_in_city") == 1)
        .orderBy("fadr_pct", "city", "address_type")
    )
