"""File sources and sinks."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from doorstep.schema import DELIVERIES, DELIVERY_COLUMNS, REQUIRED_COLUMNS


def _by_header(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """The declared columns of a CSV by the names in its header, in whatever order; others are left out.

    The first header gives the order, and every other file is held against it as it is read.
    """
    header = spark.read.option("header", True).csv(path).columns
    if missing := [c for c in types if c not in header]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    found = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.schema(found).csv(path).select(*types)


def read_deliveries(spark: SparkSession, path: str, *, infer: bool = False) -> DataFrame:
    """Attempt records from CSV with a header row, bound by the header's names.

    The declared schema costs no extra pass. ``infer=True`` reads the data once more to guess the
    types, and will take an all-digit id for a number.
    """
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return _by_header(spark, path, {f.name: f.dataType for f in DELIVERIES})


def read_deliveries_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed records, and as text with a ``reason`` those where a value is missing or does not parse.

    A value that is there must parse; the required ones must be there. The split is made by expressions over text columns. The CSV reader's own corrupt-record column
    would not do: it looks only at the columns a query selects.
    """
    text = _by_header(spark, path, {c: T.StringType() for c in DELIVERY_COLUMNS})
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in DELIVERIES}
    reasons = [
        F.when(F.col(c).isNotNull() & value.isNull(), F.lit(f"{c} does not parse")).otherwise(
            F.when(value.isNull(), F.lit(f"{c} is missing")) if c in REQUIRED_COLUMNS else F.lit(None)
        )
        for c, value in typed.items()
    ]
    judged = text.withColumn("reason", F.concat_ws("; ", *reasons))
    good = judged.where("reason = ''").select([value.alias(c) for c, value in typed.items()])
    return good, judged.where("reason <> ''")


def write_deliveries_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def load_json_records(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """API records landed as JSON: one object per line, or with ``multi_line`` one array per file.

    A file that holds one array is read by one task, so land large feeds as lines.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_partitioned(
    df: DataFrame, path: str, by: str = "city", *, max_records_per_file: int = 20_000_000
) -> int:
    """Overwrite ``path`` with one directory per value of ``by``; returns the rows written.

    Rebalancing first gives each directory a few large files instead of one per input task, and
    splits a hot value over several tasks. The row count is observed in the writing stage itself,
    so it costs no second pass.
    """
    written = Observation("write_partitioned")
    (
        df.hint("rebalance", by)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(by)
        .parquet(path)
    )
    return written.get["rows"]


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    expected_rows: int | None = None,
) -> DataFrame:
    """All partitions read back; with ``expected_rows``, fails unless the count is equal.

    The schema keeps the partition column's type: a city ``01`` would be read as a number without it.
    """
    df = spark.read.schema(schema).parquet(path)
    if expected_rows is not None:
        found = df.count()
        if found != expected_rows:
            raise ValueError(f"{path}: wrote {expected_rows} rows but read back {found}")
    return df


def export_mart(mart: DataFrame, path: str) -> None:
    """Whole summary table to CSV with a header and no index column."""
    mart.write.mode("overwrite").option("header", True).csv(path)
