import itertools
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from doorstep.ml import features, forest, metrics, node_table
from doorstep.schema import FEATURES
from doorstep.sources.star import deliveries


@pytest.fixture(scope="module")
def df(spark, sf_dir):
    return deliveries(spark, sf_dir.replace("sf0.001", "sf0.01")).cache()


@pytest.fixture(scope="module")
def parts(df):
    return features.split(df)


@pytest.fixture(scope="module")
def model(parts):
    return forest.train(parts[0], trees=20, depth=5)


def test_codes_are_alphabetical_and_keep_unseen(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "city string")
    model = features.label_encoder(["city"]).fit(seen)
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "city string")
    assert [r.city_enc for r in model.transform(new).collect()] == [0, 1, 2, 3, 3]


def test_feature_order(df):
    row = features.feature_pipeline().fit(df).transform(df)
    vector, *values = row.select("features", *FEATURES).first()
    assert list(vector.toArray()) == [float(v) for v in values]


def test_split_is_stable_and_stratified(df, parts):
    train, test = parts
    assert train.count() + test.count() == df.count()
    moved = features.split(df.repartition(7))[1]
    assert moved.exceptAll(test).isEmpty() and test.exceptAll(moved).isEmpty()
    whole = {r[0]: r[1] for r in df.groupBy("is_successful").count().collect()}
    drawn = {r[0]: r[1] for r in test.groupBy("is_successful").count().collect()}
    assert drawn == {c: int(n * 0.2 + 0.5) for c, n in whole.items()}


@pytest.mark.parametrize("digits", [0, 1, 4])
@pytest.mark.parametrize("share", [0.0, 0.001, 0.37, 1.0])
def test_split_by_brute_force(spark, digits, share, monkeypatch):
    """Any number of bins gives the rows that sorting each class by the hash of the id gives."""
    import hashlib

    monkeypatch.setattr(features, "BIN_DIGITS", digits)
    rows = [(f"d{i}", (None, 0, 1, 1)[i % 4]) for i in range(401)] + [(None, 1)]
    df = spark.createDataFrame(rows, "delivery_id string, is_successful int")
    want = set()
    for label in (None, 0, 1):
        ids = sorted((i for i, c in rows if c == label and i), key=lambda i: hashlib.md5(i.encode()).hexdigest())
        want |= set(ids[: int(len(ids) * share + 0.5)])
    train, test = features.split(df, test=share)
    got = {r.delivery_id for r in test.collect()}
    # A row without an id is never tested on.
    assert got == want and train.count() == len(rows) - len(got)


def test_a_row_without_a_bucket_has_no_prediction(attempts, df, model, tmp_path):
    bad = attempts({"order_value": 10_000.01}, {"order_value": None}, {"attempt_number": None}, {})
    for scored in (forest.predict(model, bad), forest.predict_by_cell(model, bad, str(tmp_path / "s"))):
        assert sorted(r.delivery_id for r in scored.where("prediction IS NULL AND probability IS NULL").collect()) == ["d0", "d1", "d2"]
        assert scored.where("prediction IS NOT NULL").count() == 1
    whole = forest.what_if(model, bad, {}).first()
    assert whole.probability == pytest.approx(forest.predict(model, attempts({})).first().probability)
    again = forest.train(df.unionByName(bad), trees=2, depth=2)
    assert again.stages[-1].getNumTrees == 2


def test_cells_count_every_attempt(df):
    assert forest.training_cells(df).agg(F.sum("weight")).first()[0] == df.count()
    assert forest.feature_cells(df).count() <= 5 * 4 * 6 * 4 * 3 * 2 * 2


def test_training_is_repeatable(parts, model):
    again = forest.train(parts[0].repartition(5), trees=20, depth=5)
    assert again.stages[-1].featureImportances == model.stages[-1].featureImportances


def test_predictions_separate_the_classes(parts, model):
    scored = forest.predict(model, parts[1])
    assert scored.where("probability < 0 OR probability > 1").isEmpty()
    assert scored.where((F.col("probability") > 0.5).cast("int") != F.col("prediction")).isEmpty()
    result = metrics.classification_metrics(scored).first()
    assert result.roc_auc > 0.6 and result.accuracy > 0.7


def test_scoring_by_cell_is_the_same(df, model, tmp_path):
    columns = ["delivery_id", "prediction", "probability"]
    direct = forest.predict(model, df)
    by_cell = forest.predict_by_cell(model, df, str(tmp_path / "scores"))
    assert by_cell.columns == direct.columns
    assert direct.select(columns).exceptAll(by_cell.select(columns)).isEmpty()
    assert by_cell.count() == df.count()


def test_scoring_by_cell_keeps_null_features(attempts, model, tmp_path):
    odd = attempts({"city": None}, {"city": "Atlantis"}, {})
    assert forest.predict_by_cell(model, odd, str(tmp_path / "s")).count() == 3


def test_metrics_on_weighted_cells_equal_metrics_on_rows(parts, model):
    rows = metrics.classification_metrics(forest.predict(model, parts[1])).first()
    cells = forest.predict_cells(model, forest.feature_cells(parts[1], "is_successful"))
    assert tuple(metrics.classification_metrics(cells, weight="weight").first()) == pytest.approx(
        tuple(rows)
    )
    by_row = metrics.class_report(forest.predict(model, parts[1])).collect()
    assert metrics.class_report(cells, weight="weight").collect() == by_row


def test_importances(spark, model):
    ranked = forest.feature_importance(spark, model).collect()
    assert {r.feature for r in ranked} == set(FEATURES)
    assert sum(r.importance for r in ranked) == pytest.approx(1)
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)


def test_saved_model_predicts_the_same(df, model, tmp_path):
    forest.save_model(model, str(tmp_path / "m"))
    forest.save_model(model, str(tmp_path / "m"))
    loaded = forest.load_model(str(tmp_path / "m"))
    columns = ["delivery_id", "probability"]
    a, b = (forest.predict(m, df).select(columns) for m in (model, loaded))
    assert a.exceptAll(b).isEmpty()


def test_the_saved_nodes_score_like_the_model(spark, attempts, df, model, tmp_path):
    path = str(tmp_path / "m")
    forest.save_model(model, path)
    nodes, labels = node_table.node_table(spark, path), node_table.label_table(spark, path)
    assert nodes.select("tree").distinct().count() == 20
    assert nodes.where("(feature IS NULL) <> (left IS NULL) OR (categories IS NULL AND threshold IS NULL AND left IS NOT NULL)").isEmpty()
    odd = attempts(
        {"city": "Atlantis"}, {"city": None, "address_type": None}, {"order_value": 20_000.0}, {"attempt_number": None}, {}, {}
    )
    rows = df.unionByName(odd)
    key = lambda r: r.delivery_id
    ours = sorted(node_table.score(rows, nodes, labels, depth=5).collect(), key=key)
    theirs = sorted(forest.predict(model, rows).collect(), key=key)
    assert len(ours) == len(theirs) == rows.count()
    for a, b in zip(ours, theirs):
        assert a.delivery_id == b.delivery_id and a.probability == pytest.approx(b.probability, abs=1e-12)
        assert a.prediction == b.prediction
    plan = node_table.score(rows, nodes, labels, depth=5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "UDF" not in plan


def test_what_if(attempts, df, model):
    base = attempts(
        {"address_type": "Apartment", "delivery_window": "Morning (9-12)", "city": "ASIA", "order_value": 2000.0}
    )
    change = {"delivery_window": "Evening (15-19)", "has_delivery_preference": 1, "proximity_alert_sent": 1}
    result = {r.scenario: r for r in forest.what_if(model, base, {"better": change}).collect()}
    assert result["as_is"].uplift_points == 0
    expected = forest.predict(model, base).first().probability
    assert result["as_is"].probability == pytest.approx(expected)
    gain = result["better"].probability - result["as_is"].probability
    assert gain > 0 and result["better"].uplift_points == pytest.approx(100 * gain)
    whole = {r.scenario: r.probability for r in forest.what_if(model, df, {"better": change}).collect()}
    mean = forest.predict(model, df).agg(F.avg("probability")).first()[0]
    assert whole["as_is"] == pytest.approx(mean)
    by_address = forest.what_if(model, df, {"better": change}, by=("address_type",))
    assert by_address.count() == 2 * df.select("address_type").distinct().count()
    assert by_address.where("scenario = 'as_is' AND uplift_points <> 0").isEmpty()


def brute_auc(pairs):
    positives = [s for s, y in pairs if y == 1]
    negatives = [s for s, y in pairs if y == 0]
    won = sum((p > n) + (p == n) / 2 for p, n in itertools.product(positives, negatives))
    return won / (len(positives) * len(negatives))


@pytest.mark.parametrize("digits", [1, 2, 12])
@pytest.mark.parametrize("ranges", [None, 2, 16, 256])
def test_auc_is_exact_for_any_cut(spark, digits, ranges):
    rng = random.Random(digits)
    pairs = [(round(rng.random() ** 3, digits), int(rng.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "probability double, is_successful int")
    result = metrics.classification_metrics(df, ranges=ranges).first()
    assert result.roc_auc == pytest.approx(brute_auc(pairs))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="probability", labelCol="is_successful", numBins=0
    )
    assert result.roc_auc == pytest.approx(evaluator.evaluate(df))
    assert result.accuracy == pytest.approx(sum((s >= 0.5) == (y == 1) for s, y in pairs) / 400)


def test_auc_of_many_distinct_scores(spark):
    """A score of its own for every row, spread over parts that no task sees whole."""
    n = 20_000
    df = spark.range(n).selectExpr(f"pmod(xxhash64(id), 1000003) / 1000003 + id * 1e-12 AS probability", "cast(pmod(xxhash64(id, 7), 3) = 0 AS int) AS is_successful")
    df = df.unionByName(df.limit(5).selectExpr("cast(null AS double) AS probability", "1 AS is_successful"))
    rows = sorted((r.probability, r.is_successful) for r in df.where("probability IS NOT NULL").collect())
    ranks = sum(i + 1 for i, (_, y) in enumerate(rows) if y)
    pos = sum(y for _, y in rows)
    want = (ranks - pos * (pos + 1) / 2) / (pos * (n - pos))
    assert len({s for s, _ in rows}) == n
    assert metrics.classification_metrics(df).first().roc_auc == pytest.approx(want)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.3, 1), (0.6, 1)], "probability double, is_successful int")
    assert tuple(metrics.classification_metrics(df).first()) == (0.5, None)
    assert tuple(metrics.classification_metrics(df.limit(0)).first()) == (None, None)


def test_confusion_and_report(spark):
    pairs = [(1, 1)] * 5 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 2
    df = spark.createDataFrame(pairs, "is_successful int, prediction int")
    matrix = metrics.confusion_matrix(df).orderBy("actual").collect()
    assert [tuple(r) for r in matrix] == [(0, 2, 2), (1, 1, 5)]
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert report["1"].precision == pytest.approx(5 / 7)
    assert report["0"].recall == 0.5 and report["0"].f1 == pytest.approx(4 / 7)
    assert report["macro avg"].recall == pytest.approx((0.5 + 5 / 6) / 2)
    assert report["weighted avg"].recall == pytest.approx(0.7)
    assert [report[c].support for c in ("0", "1", "macro avg")] == [4, 6, 10]


def test_report_without_a_predicted_class(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "is_successful int, prediction int")
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert (report["0"].precision, report["0"].f1) == (0.0, 0.0)
    assert [tuple(r) for r in metrics.confusion_matrix(df).orderBy("actual").collect()] == [
        (0, 0, 1), (1, 0, 1),
    ]


def test_accuracy_is_that_of_the_prediction(spark):
    tie = spark.createDataFrame([(0, 0.5, 0), (1, 0.9, 1)], "is_successful int, probability double, prediction int")
    assert metrics.classification_metrics(tie).first().accuracy == 1.0
    assert metrics.classification_metrics(tie.drop("prediction")).first().accuracy == 0.5


def test_more_cities_than_default_bins(spark, attempts):
    rows = [{"city": f"c{i % 60}", "is_successful": i % 2} for i in range(240)]
    model = forest.train(attempts(*rows), trees=2, depth=2)
    assert forest.predict(model, attempts({"city": "c59"})).count() == 1


def test_the_model_does_not_depend_on_the_input_partitions(spark, sf_dir):
    df = deliveries(spark, sf_dir)
    scores = []
    for n in (2, 5):
        model = forest.train(df.repartition(n), trees=3, depth=4)
        scores.append([round(x, 12) for x in model.stages[-1].featureImportances.toArray()])
    assert scores[0] == scores[1]
