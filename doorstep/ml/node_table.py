"""A saved forest as two plain tables, and scoring by joins with them: no vectors, no model objects, no Python.

``nodes`` has a row per node of every tree: (tree, node, feature, categories, threshold, left, right, probability). A leaf has no
feature. A named feature goes left if its code is in ``categories``, a number if it is at most ``threshold``. ``labels`` has a row
per named feature and value: (feature, value, code); any other value has the code after the last.

Both are read from the files that the model was saved as, so whatever reads Parquet can score with it.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doorstep.functions.labels import value_bucket_code
from doorstep.ml.features import CATEGORIES, RAW_FEATURES, complete
from doorstep.schema import FOREST


def _stage(spark: SparkSession, model: str, kind: str) -> DataFrame:
    """The data of the model's only stage of a kind, whatever its place and id."""
    return spark.read.option("basePath", f"{model}/stages").parquet(f"{model}/stages/*_{kind}_*/data")


def node_table(spark: SparkSession, model: str) -> DataFrame:
    """The nodes of the forest saved at ``model``."""
    saved = _stage(spark, model, "RandomForestClassifier").select(F.col("treeID").alias("tree"), "nodeData.*")
    counts = F.col("impurityStats")
    is_leaf = F.col("leftChild") < 0
    named = F.col("split.numCategories") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    return saved.select(
        "tree",
        F.col("id").alias("node"),
        F.when(~is_leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~is_leaf & named, values).alias("categories"),
        F.when(~is_leaf & ~named, values[0]).alias("threshold"),
        F.when(~is_leaf, F.col("leftChild")).alias("left"),
        F.when(~is_leaf, F.col("rightChild")).alias("right"),
        (counts[1] / F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)).alias("probability"),
    )


def label_table(spark: SparkSession, model: str) -> DataFrame:
    """The codes of the named features' values."""
    saved = _stage(spark, model, "StringIndexer").select(F.posexplode("labelsArray").alias("at", "values"))
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return saved.select(F.get(names, "at").alias("feature"), F.posexplode("values").alias("code", "value")).select(
        "feature", "value", F.col("code").cast("double").alias("code")
    )


def coded(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """``cells`` (raw features) with ``x``, the numbers that the trees ask for; null if one is missing."""
    for feature in CATEGORIES:
        own = labels.where(F.col("feature") == feature)
        known = own.select(F.col("value").alias("_value"), F.col("code").alias(f"_{feature}"))
        unseen = own.agg(F.count("*").cast("double")).scalar()
        cells = cells.join(known, cells[feature] == known["_value"], "left").drop("_value")
        cells = cells.withColumn(f"_{feature}", F.coalesce(f"_{feature}", unseen))
    numbers = [F.col(f"_{c}" if c in CATEGORIES else c).cast("double") for c in RAW_FEATURES]
    rest = [c for c in RAW_FEATURES if c not in CATEGORIES]
    return cells.withColumn("x", F.when(complete(rest), F.array(*numbers))).drop(*[f"_{c}" for c in CATEGORIES])


def _next(own: Column) -> Column:
    goes_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", own)).otherwise(
        own <= F.col("threshold")
    )
    return F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))


def score_cells(cells: DataFrame, nodes: DataFrame, labels: DataFrame, *, depth: int = FOREST["maxDepth"]) -> DataFrame:
    """``cells`` of raw features with the forest's mean probability; null where a number is missing.

    Every cell goes down every tree, a level per join with the nodes. Cells number what the feature domains allow,
    however many attempts there are; nodes what the trees' depth allows.
    """
    trees = nodes.agg(F.max("tree")).scalar()
    placed = coded(cells.select(RAW_FEATURES).distinct(), labels)
    walk = placed.where("x IS NOT NULL").withColumns(
        {"tree": F.explode(F.sequence(F.lit(0), trees)), "node": F.lit(0)}
    )
    inner = nodes.drop("probability")
    for _ in range(depth):
        walk = walk.join(inner, ["tree", "node"]).withColumn("node", _next(F.get("x", F.col("feature")))).drop(
            "feature", "categories", "threshold", "left", "right"
        )
    leaves = walk.join(nodes.select("tree", "node", "probability"), ["tree", "node"])
    scores = leaves.groupBy(*RAW_FEATURES).agg(F.avg("probability").alias("probability"))
    scores = scores.toDF(*[f"_{c}" for c in RAW_FEATURES], "probability")
    same = [cells[c].eqNullSafe(scores[f"_{c}"]) for c in RAW_FEATURES]
    return cells.join(scores, same, "left").select(*cells.columns, "probability")


def score(df: DataFrame, nodes: DataFrame, labels: DataFrame, *, depth: int = FOREST["maxDepth"]) -> DataFrame:
    """``df`` of attempts with the probability and the likelier class; a tie is class 0, as the library decides it."""
    cells = df.withColumn("order_value_bucket", value_bucket_code())
    scored = score_cells(cells, nodes, labels, depth=depth)
    likelier = F.when(F.col("probability").isNotNull(), (F.col("probability") > 0.5).cast("int"))
    return scored.select(*df.columns, likelier.alias("prediction"), "probability")
