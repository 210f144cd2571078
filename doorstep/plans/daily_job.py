"""The daily batch job: ingest, stage, build marts, check, export."""

from dataclasses import dataclass

from pyspark.sql import SparkSession

from doorstep.operators.quality import (
    assert_checks,
    landing_checks,
    mart_checks,
    not_empty,
    run_checks,
    unique,
)
from doorstep.operators.staging import stage_deliveries
from doorstep.operators.summary import fadr_by_segment, mart_city_address, mart_window_alerts, summarise
from doorstep.schema import DELIVERIES, MART_MIN_ATTEMPTS
from doorstep.sources import publish
from doorstep.sources.files import export_mart, read_deliveries_checked


@dataclass(frozen=True)
class DailyOutputs:
    """Tables and exports of one run of the job."""

    root: str

    @classmethod
    def published(cls, spark: SparkSession, out: str) -> "DailyOutputs | None":
        """The outputs of the last run that went through; None if there is none."""
        version = publish.current(spark, out)
        return version and cls(version)

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def export(self, name: str) -> str:
        return f"{self.root}/exports/{name}"


def run_daily(
    spark: SparkSession, source: str, out: str, *, mart_min_attempts: int = MART_MIN_ATTEMPTS, keep: int = 2
) -> DailyOutputs:
    """Run every step in order and stop at the first failure; the outputs of a run replace the former ones at once.

    A run writes to a folder of its own under ``out``, which is published when everything is written and checked:
    a run that stops anywhere leaves the former outputs as they were. The last ``keep`` published runs stay,
    so that who reads one is not cut off by the next.

    The CSV is read as text; records that do not fit are set apart in ``rejected`` with the reason, and
    the rest lands as typed Parquet, of which later steps scan only their columns. The checks run before
    the marts are built, so nothing unsound gets into one. One scan makes the table ``summary``, which the three
    marts are rolled up from; summaries of several loads can be merged. All three marts are exported.
    """
    outputs = DailyOutputs(publish.new_version(out))

    good, rejected = read_deliveries_checked(spark, source)
    good.write.mode("overwrite").parquet(outputs.table("deliveries"))
    rejected.write.mode("overwrite").parquet(outputs.table("rejected"))
    landed = spark.read.schema(DELIVERIES).parquet(outputs.table("deliveries"))
    staged = stage_deliveries(landed)
    assert_checks(run_checks(staged, landing_checks()))

    summarise(staged).write.mode("overwrite").parquet(outputs.table("summary"))
    summary = spark.read.parquet(outputs.table("summary"))
    marts = {
        "fadr_by_segment": fadr_by_segment(summary),
        "mart_fadr_by_city_and_address": mart_city_address(summary),
        "mart_fadr_by_window_and_alerts": mart_window_alerts(
            summary, min_attempts=mart_min_attempts
        ),
    }
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(outputs.table(name))

    built = {name: spark.read.parquet(outputs.table(name)) for name in marts}
    assert_checks(run_checks(built["fadr_by_segment"], [unique("city", "address_type")]))
    # A small load may leave no segment above the window mart's threshold, so only the city mart
    # has to hold rows.
    by_city = built["mart_fadr_by_city_and_address"]
    assert_checks(run_checks(by_city, [*mart_checks(), not_empty()]))
    assert_checks(run_checks(built["mart_fadr_by_window_and_alerts"], mart_checks()))
    for name, mart in built.items():
        export_mart(mart, outputs.export(name))
    publish.switch(spark, out, outputs.root, keep=keep)
    return outputs
