"""Feature stages and the train/test split."""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from doorstep.functions.labels import value_bucket_code_sql
from doorstep.schema import FEATURES, LABEL, TEST_SHARE

CATEGORIES = ["address_type", "delivery_window", "city"]
RAW_FEATURES = [
    *CATEGORIES,
    "order_value_bucket",
    "attempt_number",
    "has_delivery_preference",
    "proximity_alert_sent",
]


def bucket_stage() -> SQLTransformer:
    """Adds the value bucket code; a SQL stage is saved with the rest of the pipeline."""
    return SQLTransformer(
        statement=f"SELECT *, {value_bucket_code_sql()} AS order_value_bucket FROM __THIS__"
    )


def label_encoder(columns: list[str] = CATEGORIES) -> StringIndexer:
    """Codes 0..n-1 in alphabetical order; a value not seen in fitting gets the code n."""
    return StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_enc" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def assembler() -> VectorAssembler:
    """The seven features in their fixed order.

    A missing number, such as the code of a value outside the bucket range, is NaN here: see :func:`complete`.
    """
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")


def complete(columns: list[str] = FEATURES) -> Column:
    """Whether a row has all its features. One that has not is neither trained on nor predicted."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def feature_pipeline() -> Pipeline:
    return Pipeline(stages=[bucket_stage(), label_encoder(), assembler()])


#: Hex digits of the id's hash that name a bin: 65,536 bins.
BIN_DIGITS = 4


def test_condition(
    df: DataFrame, *, test: float = TEST_SHARE, key: str = "delivery_id", label: str = LABEL
) -> Column:
    """Whether a row belongs to the test part: of each class exactly its share, to the nearest row.

    Rows go by the hash of their id, and of every class the first go to the test part, so the parts do not depend on how
    the data is partitioned. The place of the cut comes from a count per class and bin of hashes; only the rows of
    the bin it falls into are ranked. What goes through the driver is a row per class. The result is a plain
    condition on id and label, so later scans filter by it without a shuffle. Rows without a label are a class.
    Rows that repeat the id at the cut stay together; rows without an id are trained on.
    """
    digest = F.md5(F.col(key).cast("string"))
    rows = df.select(F.col(label).alias("label"), digest.alias("hash"), F.col(key).cast("string").alias("id"))
    rows = rows.where("id IS NOT NULL").withColumn("bin", F.substring("hash", 1, BIN_DIGITS))
    bins = rows.groupBy("label", "bin").agg(F.count("*").alias("n"))
    by_bin = Window.partitionBy("label").orderBy("bin")
    placed = bins.withColumns(
        {
            "upto": F.sum("n").over(by_bin),
            "wanted": F.floor(F.sum("n").over(Window.partitionBy("label")) * test + 0.5),
        }
    )
    cut = placed.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))).select(
        F.col("label").alias("of"), F.col("bin").alias("at"), (F.col("wanted") - F.col("upto") + F.col("n")).alias("left")
    )
    inside = rows.join(cut, F.col("label").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("at")))
    ranked = inside.withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy("hash", "id")))
    last = ranked.where("nth = left").select("label", "hash", "id").collect()
    chosen = F.lit(False)
    for row in last:
        before = (digest < row["hash"]) | ((digest == row["hash"]) & (F.col(key).cast("string") <= row["id"]))
        chosen = chosen | (F.col(label).eqNullSafe(F.lit(row["label"])) & before)
    return F.coalesce(chosen, F.lit(False))


def split(df: DataFrame, *, test: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """(train, test), stratified by the label."""
    in_test = test_condition(df, test=test)
    return df.where(~in_test), df.where(in_test)
