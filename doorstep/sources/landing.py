"""Deliveries and events landed once per application, then read by every query.

Deriving the deliveries joins the two largest tables. A report needs two or three of their columns,
so the derived table is written once, in the layout reports want, and each report scans only its
own columns of it. The folders lie under ``spark.checkpoint.dir``: they outlive any executor and
also cut the lineage.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from doorstep.schema import DELIVERIES, DELIVERY_COLUMNS
from doorstep.session import scratch_dir
from doorstep.sources import files, star
from doorstep.streaming.events import encode_events

_landed: dict[tuple[str, str, str], str] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(hadoop).exists(folder)


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], object]) -> str:
    """The folder of this kind for these tables, written by the first caller of the application.

    It is written again if someone has cleared it meanwhile.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _landed or not _exists(spark, _landed[key]):
        path = scratch_dir(spark, kind)
        write(path)
        _landed[key] = path
    return _landed[key]


def deliveries_path(spark: SparkSession, sf_dir: str) -> str:
    """Parquet, one directory per city."""
    return _once(
        spark, sf_dir, "deliveries",
        lambda path: files.write_partitioned(star.deliveries(spark, sf_dir), path),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = deliveries_path(spark, sf_dir)
    return spark.read.schema(DELIVERIES).parquet(path).select(DELIVERY_COLUMNS)


def deliveries_csv_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "csv",
        lambda path: files.write_deliveries_csv(deliveries(spark, sf_dir), path),
    )


def write_event_log(events: DataFrame, path: str) -> None:
    """Events as JSON lines added to a folder, which stands in for the message topic."""
    encode_events(events).select("value").write.mode("append").text(path)


def event_log_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "events",
        lambda path: write_event_log(star.read_events(spark, sf_dir), path),
    )
