"""Typed, cleaned attempt records."""

from pyspark.sql import DataFrame, functions as F, types as T

from doorstep.functions.labels import high_risk_flag, value_bucket_labels
from doorstep.schema import DELIVERIES


def stage_deliveries(df: DataFrame) -> DataFrame:
    """The declared columns and types, without the rows that have no ``delivery_id``.

    A value that cannot be cast becomes NULL instead of failing the job or passing for a zero; the
    quality checks then count it. A timestamp keeps its date.
    """
    return df.where(F.col("delivery_id").isNotNull()).select(
        [
            F.col(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in DELIVERIES
        ]
    )


def with_features(df: DataFrame) -> DataFrame:
    """Adds the value bucket label and the high-risk flag."""
    return df.withColumns(
        {"order_value_bucket": value_bucket_labels(), "is_high_risk": high_risk_flag()}
    )


def filter_records(df: DataFrame, **equals) -> DataFrame:
    """Records whose columns equal the given values."""
    for column, value in equals.items():
        df = df.where(F.col(column) == value)
    return df
