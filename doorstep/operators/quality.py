"""Data-quality checks, evaluated together and reported as rows."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from doorstep.schema import (
    ADDRESS_TYPES,
    DELIVERY_COLUMNS,
    MEAN_RANGE,
    REQUIRED_COLUMNS,
    WINDOWS,
)


class QualityError(AssertionError):
    """A check failed; the message lists every failing check."""


@dataclass(frozen=True)
class Check:
    """A named check. ``violations`` is an aggregate over the table; unique keys are set apart."""

    name: str
    column: str
    violations: Callable[[DataFrame], Column] | None = None
    unique_keys: tuple[str, ...] = ()


def _rows_where(name: str, column: str, broken: Callable[[], Column]) -> Check:
    return Check(name, column, lambda df: F.count_if(broken()))


def _table(name: str, column: str, broken: Callable[[DataFrame], Column]) -> Check:
    return Check(name, column, lambda df: F.coalesce(broken(df), F.lit(True)).cast("long"))


def not_null(column: str) -> Check:
    return _rows_where("not_null", column, lambda: F.col(column).isNull())


def accepted_values(column: str, values: Iterable) -> Check:
    """NULL is not a violation here; pair with ``not_null`` to forbid it."""
    allowed = list(values)
    return _rows_where("accepted_values", column, lambda: ~F.col(column).isin(allowed))


def positive(column: str) -> Check:
    """NULL counts as a violation."""
    return _rows_where(
        "positive", column, lambda: ~F.coalesce(F.col(column) > 0, F.lit(False))
    )


def null_when(column: str, flag: str, value) -> Check:
    return _rows_where(
        "null_when",
        column,
        lambda: (F.col(flag) == value) & F.col(column).isNotNull(),
    )


def not_empty() -> Check:
    return _table("not_empty", "*", lambda df: F.count("*") == 0)


def row_count(expected: int) -> Check:
    return _table("row_count", "*", lambda df: F.count("*") != expected)


def column_count(expected: int) -> Check:
    return _table("column_count", "*", lambda df: F.lit(len(df.columns) != expected))


def mean_between(column: str, low: float, high: float) -> Check:
    """Mean inside the open range; an empty table has no mean and fails."""
    return _table(
        "mean_between",
        column,
        lambda df: ~((F.avg(column) > low) & (F.avg(column) < high)),
    )


def unique(*keys: str) -> Check:
    """Violations are the key values held by more than one row; a key with a NULL is ignored."""
    return Check("unique", ",".join(keys), unique_keys=keys)


def attempt_checks() -> list[Check]:
    """Everything a sound attempts table satisfies, declared constraints included."""
    return [
        *[not_null(column) for column in REQUIRED_COLUMNS],
        unique("delivery_id"),
        accepted_values("is_successful", [0, 1]),
        accepted_values("has_delivery_preference", [0, 1]),
        accepted_values("proximity_alert_sent", [0, 1]),
        accepted_values("address_type", ADDRESS_TYPES),
        accepted_values("delivery_window", WINDOWS),
        positive("order_value"),
        null_when("failure_reason", "is_successful", 1),
        mean_between("is_successful", *MEAN_RANGE),
        column_count(len(DELIVERY_COLUMNS)),
        not_empty(),
    ]


def landing_checks() -> list[Check]:
    """The gate before the marts: every attempt check but the mean, which a small load may miss by chance."""
    return [check for check in attempt_checks() if check.name != "mean_between"]


def staging_checks() -> list[Check]:
    """The gate between staging and export."""
    return [
        not_null("delivery_id"),
        unique("delivery_id"),
        not_null("is_successful"),
        accepted_values("is_successful", [0, 1]),
    ]


def mart_checks() -> list[Check]:
    return [not_null("fadr"), not_null("total_attempts")]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: ``check_name``, ``column``, ``violations``, ``passed``.

    All row-level and table-level checks share one aggregation pass. A uniqueness check shuffles
    its keys; copies of a key collapse to one row per task before that.
    """
    aggregated = [c for c in checks if not c.unique_keys]
    parts = []
    if aggregated:
        totals = df.agg(*[c.violations(df).alias(f"v{i}") for i, c in enumerate(aggregated)])
        parts.append(
            totals.select(
                F.inline(
                    F.array(
                        *[
                            _result(c, F.coalesce(F.col(f"v{i}"), F.lit(0)))
                            for i, c in enumerate(aggregated)
                        ]
                    )
                )
            )
        )
    for check in checks:
        if check.unique_keys:
            repeated = (
                df.dropna(subset=list(check.unique_keys))
                .groupBy(*check.unique_keys)
                .agg(F.count("*").alias("copies"))
                .where(F.col("copies") > 1)
            )
            parts.append(
                repeated.agg(F.count("*").alias("v")).select(
                    F.inline(F.array(_result(check, F.col("v"))))
                )
            )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _result(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).alias("column"),
        violations.alias("violations"),
        (violations == 0).alias("passed"),
    )


def assert_checks(report: DataFrame) -> None:
    """Raise with every failing check. The report has one row per check, so collecting is safe."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.check_name}({r.column}): {r.violations}" for r in failed)
        )
