"""Success-rate (FADR) reports.

FADR is the mean of ``is_successful`` over all attempts, whatever their attempt number. Each report
is one scan with partial aggregation, so only one row per group and task is shuffled. Ties are
broken by the group keys.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.functions.labels import flag_label, high_risk_flag, value_bucket_labels_rs
from doorstep.functions.rates import attempts, failure, percent_of, success_percent
from doorstep.schema import (
    ALERT_LABELS,
    COST_PER_FAILURE,
    EVENING,
    LABEL,
    MORNING,
    PREFERENCE_LABELS,
    WORST_K,
    WORST_MIN_ATTEMPTS,
)


def success_rates(
    df: DataFrame,
    *keys: str | Column,
    count: str = "total_attempts",
    rate: str = "fadr_percent",
) -> DataFrame:
    """Attempts and success percentage per group."""
    return df.groupBy(*keys).agg(attempts().alias(count), success_percent().alias(rate))


def worst_first(df: DataFrame, rate: str, *keys: str) -> DataFrame:
    return df.orderBy(F.asc(rate), *keys)


def overall_fadr(df: DataFrame) -> DataFrame:
    return df.agg(
        attempts().alias("total_attempts"),
        F.sum(LABEL).alias("successful"),
        success_percent().alias("fadr_percent"),
        F.sum(failure()).alias("failed"),
        F.round(F.avg(failure()) * 100, 2).alias("failure_rate_percent"),
    )


def fadr_by_window(df: DataFrame) -> DataFrame:
    return worst_first(success_rates(df, "delivery_window"), "fadr_percent", "delivery_window")


def fadr_by_address(df: DataFrame) -> DataFrame:
    return worst_first(success_rates(df, "address_type"), "fadr_percent", "address_type")


def _fadr_by_flag(df: DataFrame, flag: str, labels: tuple[str, str]) -> DataFrame:
    return success_rates(df, flag).withColumn("label", flag_label(flag, labels))


def fadr_by_preference(df: DataFrame) -> DataFrame:
    return _fadr_by_flag(df, "has_delivery_preference", PREFERENCE_LABELS)


def fadr_by_alert(df: DataFrame) -> DataFrame:
    return _fadr_by_flag(df, "proximity_alert_sent", ALERT_LABELS)


def fadr_by_value_bucket(df: DataFrame) -> DataFrame:
    bucketed = df.withColumn("value_bucket", value_bucket_labels_rs())
    return worst_first(success_rates(bucketed, "value_bucket"), "fadr_percent", "value_bucket")


def fadr_by_address_window(df: DataFrame) -> DataFrame:
    """All address and window pairs, worst first."""
    keys = ("address_type", "delivery_window")
    return worst_first(
        success_rates(df, *keys, count="attempts", rate="fadr_pct"), "fadr_pct", *keys
    )


def worst_combinations(
    df: DataFrame, *, min_attempts: int = WORST_MIN_ATTEMPTS, k: int = WORST_K
) -> DataFrame:
    """The ``k`` lowest address and window pairs with more than ``min_attempts`` attempts."""
    keys = ("address_type", "delivery_window")
    busy = success_rates(df, *keys).where(F.col("total_attempts") > min_attempts)
    return worst_first(busy, "fadr_percent", *keys).limit(k)


def high_risk_cohort(df: DataFrame) -> DataFrame:
    flagged = df.withColumn("is_high_risk", high_risk_flag())
    return success_rates(flagged, "is_high_risk", count="count", rate="fadr_pct")


def cost_of_failure(df: DataFrame, *, cost: int = COST_PER_FAILURE) -> DataFrame:
    """Failed attempts per city and what they cost, dearest first."""
    failed = F.sum(failure())
    return (
        df.groupBy("city")
        .agg(
            failed.alias("failed_deliveries"),
            (failed * cost).alias("estimated_cost_inr"),
            success_percent().alias("fadr_percent"),
        )
        .orderBy(F.desc("estimated_cost_inr"), "city")
    )


def city_summary(df: DataFrame, *, city: str | None = None) -> DataFrame:
    """Attempts and success rate of every city, or of one."""
    if city is not None:
        df = df.where(F.col("city") == city)
    return success_rates(df, "city", count="attempts", rate="fadr_pct")


def rate_vs_overall(df: DataFrame, by: str = "delivery_window") -> DataFrame:
    """Success rate per group beside the overall rate, worst first.

    The overall rate is a scalar subquery over the grouped rows, which reuses their exchange: the
    attempts are scanned once.
    """
    # The subquery computes the sum before the count as well: only equal exchanges are reused.
    groups = df.groupBy(by).agg(F.sum(LABEL).alias("successful"), F.count(LABEL).alias("rated"))
    overall = groups.agg(percent_of(F.sum("successful"), F.sum("rated"))).scalar()
    return worst_first(
        groups.select(
            by,
            percent_of(F.col("successful"), F.col("rated")).alias("fadr_pct"),
            overall.alias("overall_pct"),
        ),
        "fadr_pct",
        by,
    )


def cohort_rates(df: DataFrame) -> DataFrame:
    """Attempts and success rate of three overlapping cohorts, and each rate's lead over the worst.

    A row may belong to several cohorts; it is read once and counted in each.
    """
    return cohorts_of(df, F.count_if, lambda member: F.round(F.avg(F.when(member, F.col(LABEL))) * 100, 2))


def cohorts_of(
    df: DataFrame, count: Callable[[Column], Column], rate: Callable[[Column], Column]
) -> DataFrame:
    """:func:`cohort_rates` by the aggregates that give a cohort's attempts and rate."""
    evening = F.col("delivery_window") == EVENING
    preferred = F.col("has_delivery_preference") == 1
    cohorts = {
        "office_evening_preference": (F.col("address_type") == "Office") & evening & preferred,
        "any_evening": evening,
        "apartment_morning_no_preference": (F.col("address_type") == "Apartment")
        & (F.col("delivery_window") == MORNING)
        & (F.col("has_delivery_preference") == 0),
    }
    one_row = df.agg(
        *[count(member).alias(f"{name}_attempts") for name, member in cohorts.items()],
        *[rate(member).alias(f"{name}_fadr") for name, member in cohorts.items()],
    )
    worst = F.least(*[F.col(f"{name}_fadr") for name in cohorts])
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("cohort"),
                        F.col(f"{name}_attempts").alias("attempts"),
                        F.col(f"{name}_fadr").alias("fadr_pct"),
                        F.round(F.col(f"{name}_fadr") - worst, 2).alias("points_above_worst"),
                    )
                    for name in cohorts
                ]
            )
        )
    )
