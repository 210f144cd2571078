"""Datasets behind the dashboard: headline figures, heatmap and savings scenarios."""

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.functions.rates import attempts, percent_of
from doorstep.schema import (
    COST_PER_FAILURE,
    DAILY_VOLUME,
    LABEL,
    TARGET_CAP,
    TARGET_GAIN,
    WINDOWS,
)


def kpis(df: DataFrame, *, digits: int = 1) -> DataFrame:
    """One row of headline figures; counts are 0 and rates NULL on an empty table."""
    totals = df.agg(
        attempts().alias("total_attempts"),
        F.coalesce(F.sum(LABEL), F.lit(0)).alias("successful"),
        F.count_if(F.col("attempt_number") > 1).alias("repeat_attempts"),
    )
    return kpis_of(totals, digits)


def kpis_of(totals: DataFrame, digits: int = 1) -> DataFrame:
    """The headline figures that follow from all, successful and repeat attempts."""
    totals = totals.withColumn("failed", F.col("total_attempts") - F.col("successful"))
    total = F.col("total_attempts")
    return totals.select(
        "total_attempts",
        "successful",
        "failed",
        percent_of(F.col("successful"), total, digits).alias("fadr_pct"),
        percent_of(F.col("failed"), total, digits).alias("failed_pct"),
        "repeat_attempts",
        percent_of(F.col("repeat_attempts"), total, digits).alias("repeat_pct"),
    )


def fadr_heatmap(df: DataFrame, *, city: str | None = None) -> DataFrame:
    """Success rate (%) by address type across the four windows, for every city or for one.

    The windows are named, so the pivot needs no extra pass to find them; a pair without attempts
    is NULL. Cells are unrounded.
    """
    if city is not None:
        df = df.where(F.col("city") == city)
    return heatmap_of(df, F.avg(LABEL) * 100)


def heatmap_of(df: DataFrame, rate: Column) -> DataFrame:
    """An aggregate by city and address type across the four windows."""
    columns = [w.split(" ")[0].lower() for w in WINDOWS]
    cells = df.groupBy("city", "address_type").pivot("delivery_window", WINDOWS).agg(rate)
    return cells.toDF("city", "address_type", *columns)


def savings_scenarios(
    rates: DataFrame,
    *,
    fadr: str = "fadr_pct",
    costs: tuple[int, ...] = (COST_PER_FAILURE,),
    daily_volume: int = DAILY_VOLUME,
    target: float | None = None,
) -> DataFrame:
    """Daily failures now and at the target rate, and the money saved, per input row and cost.

    ``rates`` holds one percentage per row, such as one per city, unrounded: the rate is rounded to
    one digit here, and only here. The target defaults to five points above the current rate, up to
    99 %, and is never below the current rate.
    """
    keys = [c for c in rates.columns if c != fadr]
    goal = F.lit(float(target)) if target is not None else F.least(
        F.col("current_fadr") + TARGET_GAIN, F.lit(TARGET_CAP)
    )
    goal = F.greatest(goal, F.col("current_fadr"))
    volume = F.col("daily_volume")
    return (
        rates.select(
            *keys,
            F.lit(daily_volume).cast("long").alias("daily_volume"),
            F.explode(F.array(*[F.lit(c) for c in costs])).alias("cost_per_failure"),
            F.round(fadr, 1).alias("current_fadr"),
        )
        .withColumn("target_fadr", goal)
        .withColumn("current_failures", volume * (1 - F.col("current_fadr") / 100))
        .withColumn("target_failures", volume * (1 - F.col("target_fadr") / 100))
        .withColumn(
            "daily_savings",
            (F.col("current_failures") - F.col("target_failures")) * F.col("cost_per_failure"),
        )
        .withColumn("annual_savings", F.col("daily_savings") * 365)
    )


def savings_by_city(df: DataFrame, **options) -> DataFrame:
    """:func:`savings_scenarios` from each city's own current rate."""
    by_city = df.groupBy("city").agg((F.avg(LABEL) * 100).alias("fadr_pct"))
    return savings_scenarios(by_city, **options)
