"""Counts and shares."""

from pyspark.sql import DataFrame, functions as F

from doorstep.functions.rates import percent_of
from doorstep.schema import LABEL


def counts_with_share(df: DataFrame, key: str, count: str, share: str) -> DataFrame:
    """Rows per ``key`` and their percentage of all rows of ``df``; a NULL key is a group.

    The total is an uncorrelated scalar subquery over the grouped counts. It reuses their exchange,
    so the rows are scanned once and no task sees more than the groups.
    """
    counts = df.groupBy(key).agg(F.count("*").alias(count))
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, percent_of(F.col(count), total))


def failure_reasons(df: DataFrame) -> DataFrame:
    """Why attempts failed, most frequent first."""
    failed = df.where(F.col(LABEL) == 0)
    return counts_with_share(failed, "failure_reason", "count", "pct_of_failures").orderBy(
        F.desc("count"), "failure_reason"
    )


def repeat_attempts(df: DataFrame) -> DataFrame:
    return counts_with_share(df, "attempt_number", "deliveries", "pct_of_total").orderBy(
        "attempt_number"
    )


def failure_counts(df: DataFrame) -> DataFrame:
    """Failures per stated reason, most frequent first; failures without a reason are left out."""
    stated = df.where((F.col(LABEL) == 0) & F.col("failure_reason").isNotNull())
    return (
        stated.groupBy("failure_reason")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "failure_reason")
    )


def class_balance(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.count("*").alias("count"))


def list_cities(df: DataFrame) -> DataFrame:
    return df.select("city").distinct().orderBy("city")
