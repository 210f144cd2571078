"""A file that is one large JSON array of objects, read by many tasks and put together by Spark's own operators.

The text source cuts a file at every ``}``, in parallel, wherever its blocks begin. Whether such a brace ends an object depends
on all the text before it: on whether it stands in a string, and how deep. Both are running sums. A piece is looked at twice, as
if it began inside a string and as if it began outside; the number of its quotes tells how the next one begins. Sums are
taken inside each block of the file and then over the blocks, so no task sees a whole file. Only numbers are sorted and summed:
the pieces are written once under ``spark.checkpoint.dir``, and their text meets the result by file, block and place.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from doorstep.session import scratch_dir

MALFORMED = "malformed"
PLACE = ["file", "block", "place"]


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, f"json-array-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Stretches that end before a ``}`` or at the file's end, with their file, block and place in it."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Grows along a block, which one task reads.
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _count(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def _bare(text: Column) -> Column:
    """A text that begins outside of strings, without its strings."""
    return F.regexp_replace(text, '"[^"]*("|$)', "")


def _running(df: DataFrame, name: str, value: Column, out: str, keep: bool = False) -> DataFrame:
    """``out``: the sum of ``value`` over all pieces of the file before this one."""
    df = df.withColumn(name, value)
    within = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block reaches this window.
    blocks = df.groupBy("file", "block").agg(F.sum(name).alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select(
        F.col("file").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("ahead")
    )
    met = df.join(ahead, (F.col("file") == F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at")
    return met.withColumn(out, F.col("ahead") + F.coalesce(F.sum(name).over(within), F.lit(0))).drop("ahead", *([] if keep else [name]))


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the text of every object of the arrays in the files at ``path``."""
    # An escaped character is neither a quote nor the end of one.
    plain = F.regexp_replace("value", r"\\.", "")
    pieces = _pieces(spark, path).withColumn("plain", plain)
    # What begins inside a string is outside after its first quote.
    shown = F.regexp_replace("plain", '^[^"]*("|$)', "")
    pieces = pieces.withColumns(
        {
            "quotes": _count(F.col("plain"), '"'),
            "if_outside": _count(_bare(F.col("plain")), "{"),
            "if_inside": _count(_bare(shown), "{"),
        }
    ).drop("plain")
    pieces = _kept(pieces, "pieces")
    marks = _running(pieces.drop("value"), "quotes", F.col("quotes"), "before", keep=True)
    inside = F.col("before") % 2 == 1
    ends_outside = (F.col("before") + F.col("quotes")) % 2 == 0
    marks = marks.select(
        *PLACE,
        F.when(inside, F.col("if_inside")).otherwise(F.col("if_outside")).alias("opened"),
        ends_outside.cast("long").alias("closed"),
    )
    marks = _running(_kept(marks, "braces"), "deeper", F.col("opened") - F.col("closed"), "depth")
    ends = ((F.col("closed") == 1) & (F.col("depth") + F.col("opened") == 1)).cast("long")
    marks = _running(_kept(marks.select(*PLACE, ends.alias("ends")), "ends"), "ended", F.col("ends"), "number")
    whole = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    numbered = pieces.select(*PLACE, "value").join(marks.select(*PLACE, "number"), PLACE)
    objects = numbered.groupBy("file", "number").agg(whole.alias("parts"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    # Before an object stand the bracket or comma; what follows the last one is no object.
    return objects.select("file", F.regexp_replace(text, r"^[\s\x{FEFF}]*[\[,]?\s*", "").alias("value")).where(
        F.col("value").startswith("{")
    )


def load_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of the arrays at ``path``; an object that does not fit gives what of it fits, as lines do."""
    parsed = F.from_json("value", schema)
    return array_objects(spark, path).select(parsed.alias("record")).select("record.*")
