"""Table access shared by the operators."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doorstep.session import scratch_dir

#: The characters between words: space and 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    What is used several times is computed once, and a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none, runs of white space leave no empty words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")
