"""The batch report job: every report as CSV, and the featured records by city."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from doorstep.operators import cells, counts, dashboard, marts, ranking, rates
from doorstep.operators.quality import accepted_values, assert_checks, not_null, run_checks
from doorstep.operators.staging import with_features
from doorstep.schema import WINDOWS
from doorstep.sources.files import export_mart, read_partitioned, write_partitioned

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    operator.__name__: operator
    for operator in (
        rates.overall_fadr,
        rates.fadr_by_window,
        rates.fadr_by_address,
        rates.fadr_by_preference,
        rates.fadr_by_alert,
        rates.fadr_by_value_bucket,
        rates.fadr_by_address_window,
        rates.worst_combinations,
        rates.high_risk_cohort,
        rates.cost_of_failure,
        rates.city_summary,
        rates.rate_vs_overall,
        rates.cohort_rates,
        counts.failure_reasons,
        counts.repeat_attempts,
        counts.failure_counts,
        counts.class_balance,
        counts.list_cities,
        marts.fadr_by_segment,
        marts.mart_city_address,
        marts.mart_window_alerts,
        ranking.worst_address_per_city,
        dashboard.kpis,
        dashboard.fadr_heatmap,
        dashboard.savings_by_city,
    )
}


def run_reports(spark: SparkSession, df: DataFrame, out: str) -> int:
    """Write the featured records once, then every report from them; returns the records written.

    The heatmap names its windows, so nothing is written for records with another one, or none: the job stops instead.
    The written table is read once, to count its cells; all reports are roll-ups of the table ``cells``, which cells of
    other loads can be merged with.
    """
    assert_checks(run_checks(df, [not_null("delivery_window"), accepted_values("delivery_window", WINDOWS)]))
    table = f"{out}/featured"
    featured = with_features(df)
    rows = write_partitioned(featured, table)
    featured = read_partitioned(spark, table, featured.schema, expected_rows=rows)
    cells.count_cells(featured).write.mode("overwrite").parquet(f"{out}/cells")
    counted = spark.read.parquet(f"{out}/cells")
    for name, report in cells.REPORTS.items():
        export_mart(report(counted), f"{out}/reports/{name}")
    return rows
