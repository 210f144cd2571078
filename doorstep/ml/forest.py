"""Random forest: training, scoring, importances, what-if scenarios and persistence."""

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from doorstep.functions.labels import value_bucket_code
from doorstep.ml.features import CATEGORIES, RAW_FEATURES, assembler, bucket_stage, complete, label_encoder
from doorstep.schema import FEATURES, FOREST, LABEL

# Rows that share all features and the label are trained on as one weighted row per block. The
# forest draws its bootstrap sample from these rows, so more blocks bring it closer to drawing
# single attempts; at this number a cell's share in a sample varies by at most 9 %.
BOOTSTRAP_BLOCKS = 128
# Spark seeds the bootstrap per partition, so a fixed number keeps the model the same on any cluster.
TRAINING_PARTITIONS = 16
NUMBERS = [c for c in RAW_FEATURES if c not in CATEGORIES]
# Categories that a feature has at least room for.
LEAST_BINS = 32


def feature_cells(df: DataFrame, *keys) -> DataFrame:
    """Attempts counted per combination of raw features and ``keys``, as ``weight``.

    Every feature is categorical, so the combinations number a few thousand however many attempts
    there are.
    """
    coded = df.withColumn("order_value_bucket", value_bucket_code())
    return coded.groupBy(*RAW_FEATURES, *keys).agg(F.count("*").cast("double").alias("weight"))


def training_cells(df: DataFrame, *, blocks: int = BOOTSTRAP_BLOCKS) -> DataFrame:
    block = F.pmod(F.xxhash64("delivery_id"), F.lit(blocks)).alias("block")
    return feature_cells(df, F.col(LABEL), block)


def train(
    df: DataFrame,
    *,
    trees: int = FOREST["numTrees"],
    depth: int = FOREST["maxDepth"],
    seed: int = FOREST["seed"],
    bootstrap: bool = True,
    subset: str = "auto",
    balanced: bool = False,
) -> PipelineModel:
    """Fit encoders and forest on ``df``; the model scores raw attempt records.

    Attempts without a value bucket or another number are left out. Without ``bootstrap`` every tree sees all attempts;
    ``subset`` is what a split may choose from, "all" for all features. ``balanced`` gives both classes the same total
    weight. The library joins two leaves again that predict the same class, which with one rare class are many.

    The attempts are read once. The tree passes then run over the cached cells, whose number the
    feature domains bound.
    """
    # Partitioning by the cell and sorting inside keeps the seeded bootstrap repeatable.
    order = [*RAW_FEATURES, LABEL, "block"]
    cells = (
        training_cells(df)
        .where(complete(NUMBERS))
        .repartition(TRAINING_PARTITIONS, *order)
        .sortWithinPartitions(*order)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        weighed = _balanced(cells) if balanced else cells
        encoder = label_encoder().fit(cells)
        vectors = assembler()
        forest = RandomForestClassifier(
            featuresCol="features",
            labelCol=LABEL,
            weightCol="weight",
            numTrees=trees,
            maxDepth=depth,
            maxBins=max(LEAST_BINS, *[len(labels) + 1 for labels in encoder.labelsArray]),
            seed=seed,
            bootstrap=bootstrap,
            featureSubsetStrategy=subset,
            cacheNodeIds=True,
        ).fit(vectors.transform(encoder.transform(weighed)))
        # A copy leaves the training summary behind, which would keep the cells and the session
        # inside every scoring task.
        forest = forest.copy()
    finally:
        cells.unpersist()
    return PipelineModel(stages=[bucket_stage(), encoder, vectors, forest])


def _balanced(cells: DataFrame) -> DataFrame:
    totals = {r[LABEL]: r["n"] for r in cells.groupBy(LABEL).agg(F.sum("weight").alias("n")).collect()}
    share = F.lit(None).cast("double")
    for label, n in totals.items():
        share = F.when(F.col(LABEL) == label, sum(totals.values()) / (len(totals) * n)).otherwise(share)
    return cells.withColumn("weight", F.col("weight") * share)


def _scored(stages: PipelineModel, df: DataFrame) -> DataFrame:
    return (
        stages.transform(df)
        .withColumn("prediction", F.when(complete(), F.col("prediction").cast("int")))
        .withColumn("probability", F.when(complete(), vector_to_array("probability")[1]))
        .drop("rawPrediction", "features")
    )


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with its predicted class and success probability; a map-only job.

    Both are null for a row without a value bucket or another number; it stops no batch.
    """
    return _scored(model, df).select(*df.columns, "prediction", "probability")


def predict_by_cell(model: PipelineModel, df: DataFrame, path: str) -> DataFrame:
    """Same result as :func:`predict`, for large tables: a tree walk costs far more than a join.

    Every feature combination is scored once and the scores are written to ``path``, a folder all
    executors reach. Joining that table back leaves the choice to the planner: it broadcasts the
    scores while their files are small and shuffles otherwise.
    """
    coded = df.withColumn("order_value_bucket", value_bucket_code())
    cells = coded.select(RAW_FEATURES).distinct()
    scored = predict_cells(model, cells)
    scored.write.mode("overwrite").parquet(path)
    scores = df.sparkSession.read.schema(scored.schema).parquet(path)
    same_cell = [coded[c].eqNullSafe(scores[c]) for c in RAW_FEATURES]
    return coded.join(scores, same_cell).select(
        *[coded[c] for c in df.columns], "prediction", "probability"
    )


def predict_cells(model: PipelineModel, cells: DataFrame) -> DataFrame:
    """Like :func:`predict`, for rows that already carry the value bucket code."""
    return _scored(PipelineModel(stages=model.stages[1:]), cells).select(
        *cells.columns, "prediction", "probability"
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Seven rows read off the fitted model, most important first."""
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    rows = list(zip(FEATURES, weights))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def what_if(
    model: PipelineModel, base: DataFrame, scenarios: dict[str, dict], *, by: tuple[str, ...] = ()
) -> DataFrame:
    """Mean success probability of ``base`` as it is and under each scenario's changed features.

    ``scenarios`` maps a name to the feature values it sets; ``uplift_points`` is the gain over
    the unchanged rows in percentage points. Attempts without a prediction do not count. ``by`` adds a breakdown over features. Scoring runs
    on the counted feature combinations, so its cost does not grow with the number of attempts.
    """
    cells = feature_cells(base)
    changed = [
        F.struct(
            F.lit(name).alias("scenario"),
            *[F.col(c).alias(f"_{c}") for c in by],
            *[
                (F.lit(change[c]) if c in change else F.col(c)).alias(c)
                for c in RAW_FEATURES
            ],
        )
        for name, change in {"as_is": {}, **scenarios}.items()
    ]
    expanded = cells.select("weight", F.explode(F.array(*changed)).alias("row")).select(
        "weight", "row.*"
    )
    groups = [f"_{c}" for c in by]
    predicted = F.when(F.col("probability").isNotNull(), F.col("weight"))
    means = (
        predict_cells(model, expanded)
        .groupBy("scenario", *groups)
        .agg(
            F.try_divide(F.sum(F.col("probability") * F.col("weight")), F.sum(predicted)).alias("probability")
        )
    )
    as_is = F.max(F.when(F.col("scenario") == "as_is", F.col("probability")))
    # A window here holds one row per scenario.
    base_rate = as_is.over(Window.partitionBy(groups)) if by else means.agg(as_is).scalar()
    return means.select(
        "scenario",
        *[F.col(f"_{c}").alias(c) for c in by],
        "probability",
        ((F.col("probability") - base_rate) * 100).alias("uplift_points"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Model and encoders in one bundle."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
