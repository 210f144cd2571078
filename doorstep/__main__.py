"""Jobs for ``spark-submit`` or ``python -m doorstep``."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from doorstep.ml import features, forest, metrics
from doorstep.plans.daily_job import run_daily
from doorstep.plans.reports import REPORTS, run_reports
from doorstep.session import build_session
from doorstep.sources.files import read_deliveries
from doorstep.streaming.consume import consume_events, live_rate


def load(spark: SparkSession, source: str) -> DataFrame:
    """Attempts from a Parquet table when the path says so, otherwise from CSV."""
    is_parquet = source.rstrip("/").endswith(".parquet")
    return spark.read.parquet(source) if is_parquet else read_deliveries(spark, source)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    run_daily(spark, args.source, args.out)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    REPORTS[args.name](load(spark, args.source)).show(truncate=False)


def reports(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{run_reports(spark, load(spark, args.source), args.out)} records")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    train_part, test_part = features.split(load(spark, args.source))
    model = forest.train(train_part)
    forest.save_model(model, args.model)
    scored = forest.predict_cells(model, forest.feature_cells(test_part, "is_successful"))
    metrics.classification_metrics(scored, weight="weight").show()
    metrics.class_report(scored, weight="weight").show()
    metrics.confusion_matrix(scored, weight="weight").show()
    forest.feature_importance(spark, model).show(truncate=False)


def consume(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store new events, set malformed ones apart and print the live rate after every micro-batch."""
    options = dict(option.split("=", 1) for option in args.option)
    consume_events(
        spark,
        args.out,
        args.format,
        every=args.every,
        available_now=args.available_now,
        report=lambda rate: print(rate, flush=True),
        **options,
    ).awaitTermination()
    live_rate(spark, args.out).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="doorstep", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def job(action, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(action.__name__)
        for argument in arguments:
            sub.add_argument(argument, choices=sorted(REPORTS) if argument == "name" else None)
        sub.set_defaults(action=action)
        return sub

    job(daily, "source", "out")
    job(report, "name", "source")
    job(reports, "source", "out")
    job(train, "source", "model")
    streaming = job(consume, "out")
    streaming.add_argument("--format", default="kafka")
    streaming.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    streaming.add_argument("--available-now", action="store_true")
    streaming.add_argument("--every", help="time between micro-batches, such as '10 seconds'")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.action(build_session(), args)


if __name__ == "__main__":
    main()
