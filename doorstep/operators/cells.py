"""Every report from one scan: attempts counted per cell, and each report a roll-up of the cells.

A cell is a combination of all that the reports group or filter by, outcome included. All of it has a small
domain, so the cells number some ten thousand at most however many attempts there are, and the one scan shuffles no
more than a row per cell and task. The reports have the names, columns, order and rows of those built from
the attempts themselves (``rates``, ``counts``, ``marts``, ``ranking``, ``dashboard``); cells of several loads add up.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.functions.labels import flag_label, high_risk_flag, value_bucket_labels_rs
from doorstep.functions.rates import percent_of
from doorstep.operators.dashboard import heatmap_of, kpis_of, savings_scenarios
from doorstep.operators.ranking import worst_in_each_city
from doorstep.operators.rates import cohorts_of, worst_first
from doorstep.schema import (
    ALERT_LABELS,
    COST_PER_FAILURE,
    LABEL,
    MART_MIN_ATTEMPTS,
    PREFERENCE_LABELS,
    WORST_K,
    WORST_MIN_ATTEMPTS,
)

KEYS = [
    "city",
    "address_type",
    "delivery_window",
    "has_delivery_preference",
    "proximity_alert_sent",
    "value_bucket",
    "attempt_number",
    "failure_reason",
    LABEL,
]
#: All attempts of a cell, those with a value, and the values' sum.
STATES = ["attempts", "valued", "order_value"]


def count_cells(df: DataFrame) -> DataFrame:
    """One row per cell, NULL being a key of its own; no rows for no attempts."""
    return (
        df.withColumn("value_bucket", value_bucket_labels_rs())
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("attempts"),
            F.count("order_value").alias("valued"),
            F.coalesce(F.sum("order_value"), F.lit(0.0)).alias("order_value"),
        )
    )


def merge_cells(*loads: DataFrame) -> DataFrame:
    """The cells of all loads together; each attempt must be in one of them only."""
    every = reduce(DataFrame.unionByName, loads)
    return every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in STATES])


# --- aggregates over cells that equal the aggregates over attempts ---------------------------------


def _attempts(which: Column | None = None) -> Column:
    """Attempts, of some cells only if ``which`` is given; 0 if there are none."""
    n = F.col("attempts") if which is None else F.when(which, F.col("attempts"))
    return F.coalesce(F.sum(n), F.lit(0))


def _rated() -> Column:
    return F.sum(F.when(F.col(LABEL).isNotNull(), F.col("attempts")))


def _successful() -> Column:
    return F.sum(F.col(LABEL) * F.col("attempts"))


def _failed() -> Column:
    return F.sum((1 - F.col(LABEL)) * F.col("attempts"))


def _fraction(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def _percent() -> Column:
    return F.round(_fraction(_successful(), _rated()) * 100, 2)


def success_rates(
    cells: DataFrame, *keys: str | Column, count: str = "total_attempts", rate: str = "fadr_percent"
) -> DataFrame:
    """Attempts and success percentage per group."""
    return cells.groupBy(*keys).agg(_attempts().alias(count), _percent().alias(rate))


def rates_at_levels(cells: DataFrame, *levels: tuple[str, ...]) -> DataFrame:
    """Attempts and success percentage at several levels of grouping at once, by grouping sets.

    ``level`` is the number that :func:`grouping_id` gives: the bits of the keys a row is *not* grouped by. It
    tells a key that is NULL from one that is rolled up.
    """
    keys = [k for k in KEYS if any(k in level for level in levels)]
    sets = [[F.col(k) for k in level] for level in levels]
    return cells.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("level"), _attempts().alias("total_attempts"), _percent().alias("fadr_percent")
    )


# --- the reports -----------------------------------------------------------------------------------


def overall_fadr(cells: DataFrame) -> DataFrame:
    return cells.agg(
        _attempts().alias("total_attempts"),
        _successful().alias("successful"),
        _percent().alias("fadr_percent"),
        _failed().alias("failed"),
        F.round(_fraction(_failed(), _rated()) * 100, 2).alias("failure_rate_percent"),
    )


def fadr_by_window(cells: DataFrame) -> DataFrame:
    return worst_first(success_rates(cells, "delivery_window"), "fadr_percent", "delivery_window")


def fadr_by_address(cells: DataFrame) -> DataFrame:
    return worst_first(success_rates(cells, "address_type"), "fadr_percent", "address_type")


def fadr_by_preference(cells: DataFrame) -> DataFrame:
    flag = "has_delivery_preference"
    return success_rates(cells, flag).withColumn("label", flag_label(flag, PREFERENCE_LABELS))


def fadr_by_alert(cells: DataFrame) -> DataFrame:
    flag = "proximity_alert_sent"
    return success_rates(cells, flag).withColumn("label", flag_label(flag, ALERT_LABELS))


def fadr_by_value_bucket(cells: DataFrame) -> DataFrame:
    return worst_first(success_rates(cells, "value_bucket"), "fadr_percent", "value_bucket")


def fadr_by_address_window(cells: DataFrame) -> DataFrame:
    keys = ("address_type", "delivery_window")
    return worst_first(success_rates(cells, *keys, count="attempts", rate="fadr_pct"), "fadr_pct", *keys)


def worst_combinations(cells: DataFrame, *, min_attempts: int = WORST_MIN_ATTEMPTS, k: int = WORST_K) -> DataFrame:
    keys = ("address_type", "delivery_window")
    busy = success_rates(cells, *keys).where(F.col("total_attempts") > min_attempts)
    return worst_first(busy, "fadr_percent", *keys).limit(k)


def high_risk_cohort(cells: DataFrame) -> DataFrame:
    flagged = cells.withColumn("is_high_risk", high_risk_flag())
    return success_rates(flagged, "is_high_risk", count="count", rate="fadr_pct")


def cost_of_failure(cells: DataFrame, *, cost: int = COST_PER_FAILURE) -> DataFrame:
    by_city = cells.groupBy("city").agg(
        _failed().alias("failed_deliveries"),
        (_failed() * cost).alias("estimated_cost_inr"),
        _percent().alias("fadr_percent"),
    )
    return by_city.orderBy(F.desc("estimated_cost_inr"), "city")


def city_summary(cells: DataFrame) -> DataFrame:
    return success_rates(cells, "city", count="attempts", rate="fadr_pct")


def rate_vs_overall(cells: DataFrame, by: str = "delivery_window") -> DataFrame:
    groups = cells.groupBy(by).agg(_successful().alias("successful"), _rated().alias("rated"))
    overall = groups.agg(percent_of(F.sum("successful"), F.sum("rated"))).scalar()
    rate = percent_of(F.col("successful"), F.col("rated")).alias("fadr_pct")
    return worst_first(groups.select(by, rate, overall.alias("overall_pct")), "fadr_pct", by)


def cohort_rates(cells: DataFrame) -> DataFrame:
    def rate(member: Column) -> Column:
        rated = F.when(member & F.col(LABEL).isNotNull(), F.col("attempts"))
        return F.round(_fraction(F.sum(rated * F.col(LABEL)), F.sum(rated)) * 100, 2)

    return cohorts_of(cells, _attempts, rate)


def _with_share(cells: DataFrame, key: str, count: str, share: str) -> DataFrame:
    counts = cells.groupBy(key).agg(_attempts().alias(count))
    return counts.withColumn(share, percent_of(F.col(count), counts.agg(F.sum(count)).scalar()))


def failure_reasons(cells: DataFrame) -> DataFrame:
    shares = _with_share(cells.where(F.col(LABEL) == 0), "failure_reason", "count", "pct_of_failures")
    return shares.orderBy(F.desc("count"), "failure_reason")


def repeat_attempts(cells: DataFrame) -> DataFrame:
    return _with_share(cells, "attempt_number", "deliveries", "pct_of_total").orderBy("attempt_number")


def failure_counts(cells: DataFrame) -> DataFrame:
    stated = cells.where((F.col(LABEL) == 0) & F.col("failure_reason").isNotNull())
    counts = stated.groupBy("failure_reason").agg(_attempts().alias("count"))
    return counts.orderBy(F.desc("count"), "failure_reason")


def class_balance(cells: DataFrame) -> DataFrame:
    return cells.groupBy(LABEL).agg(_attempts().alias("count"))


def list_cities(cells: DataFrame) -> DataFrame:
    return cells.select("city").distinct().orderBy("city")


def fadr_by_segment(cells: DataFrame) -> DataFrame:
    keyed = cells.where(F.col("city").isNotNull() & F.col("address_type").isNotNull())
    return keyed.groupBy("city", "address_type").agg(
        F.coalesce(_rated(), F.lit(0)).alias("total_attempts"),
        F.coalesce(_successful(), F.lit(0)).alias("successful"),
        _fraction(_successful(), _rated()).alias("fadr"),
    )


def mart_city_address(cells: DataFrame) -> DataFrame:
    """The mean value is a sum in another order, so its last digit may differ."""
    return cells.groupBy("city", "address_type").agg(
        _attempts().alias("total_attempts"),
        _successful().alias("successful_deliveries"),
        F.round(_fraction(_successful(), _rated()), 4).alias("fadr"),
        F.round(_fraction(_failed(), _rated()), 4).alias("failure_rate"),
        _fraction(F.sum("order_value"), F.sum("valued")).alias("avg_order_value"),
    )


def mart_window_alerts(cells: DataFrame, *, min_attempts: int = MART_MIN_ATTEMPTS) -> DataFrame:
    segments = cells.groupBy(
        "delivery_window", "address_type", "has_delivery_preference", "proximity_alert_sent"
    ).agg(_attempts().alias("total_attempts"), F.round(_fraction(_successful(), _rated()), 4).alias("fadr"))
    return segments.where(F.col("total_attempts") > min_attempts)


def worst_address_per_city(cells: DataFrame) -> DataFrame:
    return worst_in_each_city(cells.groupBy("city", "address_type").agg(_percent().alias("fadr_pct")))


def kpis(cells: DataFrame, *, digits: int = 1) -> DataFrame:
    totals = cells.agg(
        _attempts().alias("total_attempts"),
        F.coalesce(_successful(), F.lit(0)).alias("successful"),
        _attempts(F.col("attempt_number") > 1).alias("repeat_attempts"),
    )
    return kpis_of(totals, digits)


def fadr_heatmap(cells: DataFrame) -> DataFrame:
    return heatmap_of(cells, _fraction(_successful(), _rated()) * 100)


def savings_by_city(cells: DataFrame, **options) -> DataFrame:
    rate = (_fraction(_successful(), _rated()) * 100).alias("fadr_pct")
    return savings_scenarios(cells.groupBy("city").agg(rate), **options)


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    report.__name__: report
    for report in (
        overall_fadr,
        fadr_by_window,
        fadr_by_address,
        fadr_by_preference,
        fadr_by_alert,
        fadr_by_value_bucket,
        fadr_by_address_window,
        worst_combinations,
        high_risk_cohort,
        cost_of_failure,
        city_summary,
        rate_vs_overall,
        cohort_rates,
        failure_reasons,
        repeat_attempts,
        failure_counts,
        class_balance,
        list_cities,
        fadr_by_segment,
        mart_city_address,
        mart_window_alerts,
        worst_address_per_city,
        kpis,
        fadr_heatmap,
        savings_by_city,
    )
}
