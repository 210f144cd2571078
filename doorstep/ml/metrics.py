"""Classification metrics as DataFrames."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from doorstep.schema import LABEL


def _weight(column: str | None) -> Column:
    return F.col(column) if column else F.lit(1)


def classification_metrics(
    df: DataFrame,
    *,
    label: str = LABEL,
    score: str = "probability",
    prediction: str = "prediction",
    threshold: float = 0.5,
    weight: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row: ``accuracy`` and the exact ``roc_auc``, ties counted as half.

    Accuracy is that of the ``prediction`` column where there is one, which alone knows how the model
    decides at a tie; scores without it are cut at ``threshold``.

    Rows are first counted per distinct score. The distinct scores are range-partitioned, by default into as many parts as
    the session shuffles into; negatives are cumulated inside each part, and only the parts' totals are cumulated
    over the whole, so no task sees all scores even when every row has its own. Any ``ranges`` give the same
    result. With one class only, the AUC is NULL. Rows without a score are left out.
    """
    w = _weight(weight)
    decided = F.col(prediction) if prediction in df.columns else (F.col(score) >= threshold).cast("int")
    by_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("double").alias("pos"),
            F.sum(F.when(F.col(label) == 0, w).otherwise(0)).cast("double").alias("neg"),
            F.sum(F.when(F.col(label) == decided, w).otherwise(0)).cast("double").alias("right"),
        )
        .where(F.col("pos") + F.col("neg") > 0)
    )
    dealt = by_score.repartitionByRange(ranges, "score") if ranges else by_score.repartitionByRange("score")
    ranged = dealt.withColumn("part", F.spark_partition_id())

    below = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0.0))
    parts = (
        ranged.withColumn("neg_below", neg_below)
        .groupBy("part")
        .agg(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("won"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum("right").alias("correct"),
        )
    )
    # One row per part reaches this window.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("neg").over(earlier), F.lit(0.0))
    return (
        parts.withColumn("ahead", ahead)
        .agg(
            F.sum("correct").alias("correct"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("won") + F.col("pos") * F.col("ahead")).alias("won"),
        )
        .select(
            F.try_divide("correct", F.col("pos") + F.col("neg")).alias("accuracy"),
            F.try_divide("won", F.col("pos") * F.col("neg")).alias("roc_auc"),
        )
    )


def confusion_matrix(
    df: DataFrame,
    *,
    label: str = LABEL,
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Rows are the actual class, columns ``predicted_0`` and ``predicted_1``."""
    return (
        df.groupBy(F.col(label).alias("actual"))
        .pivot(prediction, [0, 1])
        .agg(F.sum(_weight(weight)))
        .na.fill(0)
        .select(
            "actual",
            F.col("0").cast("long").alias("predicted_0"),
            F.col("1").cast("long").alias("predicted_1"),
        )
    )


def class_report(
    df: DataFrame,
    *,
    label: str = LABEL,
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class, then their macro and weighted averages.

    A ratio without a denominator is 0.
    """
    w = _weight(weight)

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.coalesce(F.sum(F.when(hit, w)), F.lit(0)).cast("double")

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    counts = df.agg(
        *[cell(a, p).alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)]
    )
    rows = []
    for c, other in ((0, 1), (1, 0)):
        hits = F.col(f"n{c}{c}")
        support = hits + F.col(f"n{c}{other}")
        predicted = hits + F.col(f"n{other}{c}")
        rows.append(
            F.struct(
                F.lit(str(c)).alias("class"),
                ratio(hits, predicted).alias("precision"),
                ratio(hits, support).alias("recall"),
                ratio(2 * hits, support + predicted).alias("f1"),
                support.cast("long").alias("support"),
            )
        )
    per_class = counts.select(rows[0].alias("c0"), rows[1].alias("c1"))
    s0, s1 = F.col("c0.support"), F.col("c1.support")

    def average(name: str, combine) -> Column:
        metrics = [
            combine(F.col(f"c0.{m}"), F.col(f"c1.{m}")).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("class"), *metrics, (s0 + s1).alias("support"))

    macro = average("macro avg", lambda a, b: (a + b) / 2)
    weighted = average("weighted avg", lambda a, b: ratio(a * s0 + b * s1, s0 + s1))
    return per_class.select(F.inline(F.array("c0", "c1", macro, weighted)))
