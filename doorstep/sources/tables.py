"""Catalog tables, views and load reports."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


def load_table(df: DataFrame, name: str, *, path: str | None = None) -> None:
    """Full refresh: drop and replace the table, so a re-run gives the same state.

    ``path`` keeps the files in a folder of the caller's choice instead of the warehouse.
    """
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def scan(spark: SparkSession, name: str, *columns: str, cached: bool = False) -> DataFrame:
    """A table, narrowed to ``columns``; ``cached`` keeps it for reuse by many aggregates.

    The cache spills to disk and is rebuilt from the table when an executor is lost.
    """
    df = spark.table(name)
    if columns:
        df = df.select(*columns)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if cached else df


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def load_report(df: DataFrame) -> DataFrame:
    """Rows loaded beside each column's name and type."""
    fields = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for f in df.schema
        ]
    )
    return (
        df.agg(F.count("*").alias("rows"))
        .select(F.explode(fields).alias("field"), "rows")
        .select("field.column_name", "field.data_type", "rows")
    )
