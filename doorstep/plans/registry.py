"""Every query by name, each from the given tables to a DataFrame."""

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from doorstep.functions import labels, scoring, text
from doorstep.functions.rates import failure
from doorstep.ml import features, forest, metrics, node_table
from doorstep.operators import cells, counts, dashboard, marts, quality, ranking, rates, staging
from doorstep.plans.daily_job import DailyOutputs, run_daily
from doorstep.schema import (
    ADDRESS_TYPES,
    CITIES,
    DELIVERIES,
    DELIVERY_COLUMNS,
    EVENING,
    EVENT,
    FEATURES,
    LABEL,
    NARROW_EVENT,
)
from doorstep.session import scratch_dir
from doorstep.sources import files, landing, tables
from doorstep.sources.landing import deliveries
from doorstep.sources.json_array import load_json_array
from doorstep.sources.star import deliveries_as_text, read_events
from doorstep.streaming import events as stream
from doorstep.streaming.consume import consume_events, live_rate

Query = Callable[[SparkSession, str], DataFrame]

# The heatmap and the JSON feed pick one city, as a dashboard user or a partner would.
ONE_CITY = "ASIA"
RULE_THRESHOLD = 0.75
SCENARIO_COSTS = (30, 45, 60)
# Records of one JSON array file: some 300 MB, a few blocks.
ARRAY_ROWS = 1_000_000

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _register(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    """A query that applies one operator to the deliveries."""
    _QUERIES[name] = lambda spark, sf_dir: operator(deliveries(spark, sf_dir))


# --- success-rate reports, counts and marts ---------------------------------------------------

for _operator in (
    rates.overall_fadr,
    rates.fadr_by_window,
    rates.fadr_by_address,
    rates.fadr_by_preference,
    rates.fadr_by_alert,
    rates.fadr_by_value_bucket,
    rates.fadr_by_address_window,
    rates.worst_combinations,
    rates.high_risk_cohort,
    rates.cost_of_failure,
    rates.city_summary,
    rates.rate_vs_overall,
    rates.cohort_rates,
    counts.failure_reasons,
    counts.repeat_attempts,
    counts.failure_counts,
    counts.class_balance,
    counts.list_cities,
    marts.fadr_by_segment,
    marts.mart_window_alerts,
    ranking.worst_address_per_city,
    dashboard.kpis,
):
    _register(_operator.__name__, _operator)


@query
def mart_city_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.mart_city_address(staging.stage_deliveries(deliveries(spark, sf_dir)))
    return mart.withColumn("avg_order_value", F.round("avg_order_value", 6))


@query
def fadr_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        dashboard.fadr_heatmap(deliveries(spark, sf_dir)),
        "morning", "afternoon", "evening", "night",
    )


@query
def fadr_heatmap_one_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        dashboard.fadr_heatmap(deliveries(spark, sf_dir), city=ONE_CITY).drop("city"),
        "morning", "afternoon", "evening", "night",
    )


@query
def savings_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        dashboard.savings_by_city(deliveries(spark, sf_dir), costs=SCENARIO_COSTS),
        "target_fadr", "current_failures", "target_failures", "daily_savings", "annual_savings",
    )


@query
def report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the report job rolls every report up from."""
    return _rounded(cells.count_cells(deliveries(spark, sf_dir)), "order_value", digits=2)


@query
def rates_at_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates by each key, by three pairs of keys and over all, from one scan."""
    levels = [
        (),
        *[(k,) for k in cells.KEYS[:7]],
        ("city", "address_type"),
        ("city", "delivery_window"),
        ("address_type", "delivery_window"),
    ]
    return cells.rates_at_levels(cells.count_cells(deliveries(spark, sf_dir)), *levels)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- projections ------------------------------------------------------------------------------

@query
def stage_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_deliveries(deliveries_as_text(deliveries(spark, sf_dir)))


@query
def value_bucket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "delivery_id", "order_value", labels.value_bucket_labels().alias("order_value_bucket")
    )


@query
def value_bucket_labels_rs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "delivery_id", "order_value", labels.value_bucket_labels_rs().alias("value_bucket")
    )


@query
def value_bucket_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.bucket_stage().transform(deliveries(spark, sf_dir)).select(
        "delivery_id", "order_value", "order_value_bucket"
    )


@query
def high_risk_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "delivery_id", labels.high_risk_flag().alias("is_high_risk")
    )


@query
def expected_success_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "delivery_id", scoring.expected_success_prob().alias("expected_prob")
    )


@query
def scalar_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "delivery_id",
        failure().alias("is_failure"),
        text.window_start_hour().alias("window_start_hour"),
        text.id_prefix("customer_id").alias("customer_prefix"),
        text.date_text("attempt_date").alias("attempt_date_text"),
        text.days_before("attempt_date", 1).alias("prev_date"),
        text.one_decimal("order_value").alias("value_1dp"),
    )


@query
def retried_homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicates by which attempts are picked."""
    wanted = (F.col("attempt_number") > 1) & F.col("address_type").isin(ADDRESS_TYPES[:3])
    return deliveries(spark, sf_dir).where(wanted).select("delivery_id")


@query
def status_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select(
        "delivery_id", "status", labels.status_class().alias("status_class")
    )


@query
def status_update_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = staging.filter_records(deliveries(spark, sf_dir), is_successful=0)
    return failed.select("delivery_id", text.status_update_payload().alias("payload"))


# --- sources and sinks ------------------------------------------------------------------------

@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_deliveries(spark, landing.deliveries_csv_path(spark, sf_dir))


@query
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types guessed from the values: the date is found, an all-digit id becomes a number."""
    inferred = files.read_deliveries(spark, landing.deliveries_csv_path(spark, sf_dir), infer=True)
    return inferred.select("delivery_id", "city", "order_value", "attempt_date", "is_successful")


@query
def csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing whose columns stand in another order is bound by its header."""
    path = scratch_dir(spark, "csv-reordered")
    turned = deliveries(spark, sf_dir).select(DELIVERY_COLUMNS[::-1])
    files.write_deliveries_csv(turned, path)
    return files.read_deliveries(spark, path)


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a landing with values broken by key, by the reason they are set apart for."""
    path = scratch_dir(spark, "csv-broken")
    k = F.col("delivery_id").cast("long")
    broken = deliveries(spark, sf_dir).withColumns(
        {
            "order_value": F.when(k % 7 == 0, "ten").otherwise(F.col("order_value").cast("string")),
            "attempt_date": F.when(k % 11 == 0, "soon").otherwise(F.col("attempt_date").cast("string")),
            "city": F.when(k % 13 != 0, F.col("city")),
        }
    )
    files.write_deliveries_csv(broken, path)
    _, rejected = files.read_deliveries_checked(spark, path)
    return rejected.select("delivery_id", "reason")


@query
def cached_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates over one cached scan of a table."""
    path = scratch_dir(spark, "cached")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.load_table(deliveries(spark, sf_dir), name, path=path)
    shared = tables.scan(spark, name, "city", "is_successful", cached=True)
    by_city = shared.groupBy(F.col("city").alias("key")).agg(F.count("*").alias("n"))
    by_outcome = shared.groupBy(F.col("is_successful").cast("string").alias("key")).agg(F.count("*").alias("n"))
    result = by_city.unionByName(by_outcome)
    out = f"{path}-out"
    result.write.parquet(out)
    shared.unpersist()
    return spark.read.schema(result.schema).parquet(out)


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_report(csv_roundtrip(spark, sf_dir))


@query
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    deliveries(spark, sf_dir).write.json(path)
    records = files.load_json_records(spark, path, DELIVERIES)
    return staging.filter_records(records, city=ONE_CITY).select(
        "delivery_id", "city", "is_successful"
    )


def _write_arrays(records: DataFrame, path: str, most: int = ARRAY_ROWS) -> None:
    """Whole JSON arrays of about ``most`` records, one to a file; a task writes one and holds no more than that."""
    spark = records.sparkSession
    files_in_all = max(1, -(-records.count() // most))
    part = F.pmod(F.xxhash64("delivery_id"), F.lit(files_in_all)).cast("int").alias("part")
    rows = records.select(part, F.lit(1).alias("order"), F.concat(F.lit(","), F.to_json(F.struct("*"))).alias("value"))
    head = "[" + json.dumps({"delivery_id": None})
    for order, value in ((0, head), (2, "]")):
        ends = spark.range(files_in_all).select(F.col("id").cast("int").alias("part"), F.lit(order).alias("order"), F.lit(value).alias("value"))
        rows = rows.unionByName(ends)
    rows.repartitionById(files_in_all, F.col("part")).sortWithinPartitions("order").select("value").write.text(path)


@query
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries as JSON arrays, each one file of several blocks, read by as many tasks as there are blocks."""
    path = scratch_dir(spark, "json-array")
    _write_arrays(deliveries(spark, sf_dir), path)
    return load_json_array(spark, path, DELIVERIES).where("delivery_id IS NOT NULL")


@query
def table_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same table twice leaves one copy; the scan is then read through a view."""
    path = scratch_dir(spark, "table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        tables.load_table(deliveries(spark, sf_dir), name, path=path)
    tables.as_view(tables.scan(spark, name, "city"), f"{name}_cities")
    return spark.sql(f"SELECT city, COUNT(*) AS n FROM {name}_cities GROUP BY city")


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    rows = files.write_partitioned(deliveries(spark, sf_dir), path)
    return files.read_partitioned(spark, path, DELIVERIES, expected_rows=rows).select(DELIVERY_COLUMNS)


@query
def featured_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature columns added, written by city and read back."""
    path = scratch_dir(spark, "featured")
    featured = staging.with_features(deliveries(spark, sf_dir))
    rows = files.write_partitioned(featured, path)
    back = files.read_partitioned(spark, path, featured.schema, expected_rows=rows)
    return back.select("delivery_id", "city", "order_value_bucket", "is_high_risk")


@query
def export_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    mart = marts.fadr_by_segment(deliveries(spark, sf_dir))
    files.export_mart(mart, path)
    return spark.read.schema(mart.schema).option("header", True).csv(path)


def _daily(spark: SparkSession, sf_dir: str) -> DailyOutputs:
    """The whole daily job from a CSV landing, run once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _daily_runs:
        source = landing.deliveries_csv_path(spark, sf_dir)
        _daily_runs[key] = run_daily(spark, source, scratch_dir(spark, "daily"))
    return _daily_runs[key]


_daily_runs: dict[tuple[str, str], DailyOutputs] = {}


def _exported(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary of the daily job as its CSV export holds it."""
    outputs = _daily(spark, sf_dir)
    schema = spark.read.parquet(outputs.table(name)).schema
    return spark.read.schema(schema).option("header", True).csv(outputs.export(name))


@query
def daily_job_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_daily(spark, sf_dir).table("fadr_by_segment"))


@query
def daily_city_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_exported(spark, sf_dir, "mart_fadr_by_city_and_address"), "avg_order_value")


@query
def daily_window_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "mart_fadr_by_window_and_alerts")


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the deliveries; their city names lie outside the city domain by design."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    checks = [
        *quality.attempt_checks(),
        quality.accepted_values("city", CITIES),
        quality.row_count(orders),
    ]
    return quality.run_checks(deliveries(spark, sf_dir), checks)


# --- streaming --------------------------------------------------------------------------------

# A backlog is worked off in bounded micro-batches, so that a failure repeats one of them only.
BACKLOG_BATCH = {"maxBytesPerTrigger": str(64 * 1024**3)}


def _received(spark: SparkSession, log: str, schema: T.StructType = EVENT) -> DataFrame:
    """The well-formed events of a log, as a stream."""
    raw = stream.event_source(spark, "text", path=log, **BACKLOG_BATCH)
    return stream.decode_events(raw, schema)[0]


def _drain(spark: SparkSession, decoded: DataFrame, *, stamped: bool = False) -> DataFrame:
    """Run an append stream over what has arrived and read its sink."""
    path = scratch_dir(spark, "sink")
    rows = stream.stamp_consumed(decoded) if stamped else decoded
    stream.append_events(
        rows, f"{path}/table", f"{path}/checkpoint", available_now=True
    ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/table")


@query
def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.encode_events(read_events(spark, sf_dir))


@query
def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain(spark, _received(spark, landing.event_log_path(spark, sf_dir)))


@query
def event_decode_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landing.event_log_path(spark, sf_dir)
    return _drain(spark, _received(spark, log, NARROW_EVENT))


@query
def event_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landing.event_log_path(spark, sf_dir)
    return _drain(spark, _received(spark, log), stamped=True).drop("consumed_at")


@query
def live_fadr(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = _received(spark, landing.event_log_path(spark, sf_dir))
    checkpoint = scratch_dir(spark, "live")
    name = checkpoint.rsplit("/", 1)[1].replace("-", "_")
    stream.show_live_fadr(
        stream.live_fadr(received), name, checkpoint, available_now=True
    ).awaitTermination()
    return spark.table(name)


@query
def event_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, then every third one again after a restart from the same checkpoint."""
    log, sink = scratch_dir(spark, "events"), scratch_dir(spark, "dedup")
    events = read_events(spark, sf_dir)

    def drain() -> None:
        stream.append_new_events(
            _received(spark, log), f"{sink}/table", f"{sink}/checkpoint", available_now=True
        ).awaitTermination()

    landing.write_event_log(events, log)
    drain()
    landing.write_event_log(events.where(F.col("delivery_id").cast("long") % 3 == 0), log)
    drain()
    table = stream.read_events_table(spark, f"{sink}/table", EVENT)
    return table.groupBy("status").agg(F.count("*").alias("n"))


def _consumed(spark: SparkSession, sf_dir: str, alter: Callable[[DataFrame], DataFrame]) -> str:
    """The outputs of the consumer job over the event log and, after a restart, messages made from it."""
    log, out = scratch_dir(spark, "events"), scratch_dir(spark, "consumed")
    events = read_events(spark, sf_dir)
    for messages in (stream.encode_events(events), alter(stream.encode_events(events))):
        messages.select("value").write.mode("append").text(log)
        consume_events(spark, out, "text", path=log, available_now=True).awaitTermination()
    return out


@query
def event_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut off half-way are set apart; the others of them are known already."""
    half = F.substring("value", 1, 40)
    out = _consumed(spark, sf_dir, lambda m: m.withColumn("value", F.when(F.col("key") == "Pune", half).otherwise(F.col("value"))))
    return spark.read.parquet(f"{out}/malformed").select("value")


@query
def event_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ten years older than the newest come last, some without a time; each is stored once."""
    older = F.regexp_replace("value", '"timestamp":"20', '"timestamp":"10')
    none = F.regexp_replace("value", '"timestamp":"[^"]*",', "")
    late = F.when(F.col("key") == "Delhi", older).when(F.col("key") == "Mumbai", none).otherwise(F.col("value"))
    out = _consumed(spark, sf_dir, lambda m: m.withColumn("value", late))
    stored = stream.read_events_table(spark, f"{out}/events", EVENT)
    return stored.groupBy("city", "status").agg(F.count("*").alias("n"))


@query
def consumer_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer's live rate over the event log and, after a restart, the same messages again."""
    return live_rate(spark, _consumed(spark, sf_dir, lambda m: m))


@query
def event_consumed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored event has a time of consumption, not before the run."""
    began = spark.sql("SELECT current_timestamp() AS now").first().now
    log = landing.event_log_path(spark, sf_dir)
    stored = _drain(spark, _received(spark, log), stamped=True)
    sound = F.col("consumed_at").isNotNull() & (F.col("consumed_at") >= F.lit(began))
    return stored.select("delivery_id", sound.alias("stamped"))


@query
def event_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded and sent to a file sink, read back as messages."""
    path = scratch_dir(spark, "published")
    received = _received(spark, landing.event_log_path(spark, sf_dir))
    stream.publish_events(
        stream.encode_events(received).select("value"), f"{path}/checkpoint", "text",
        available_now=True, path=f"{path}/topic",
    ).awaitTermination()
    return spark.read.text(f"{path}/topic")


# --- classifier -------------------------------------------------------------------------------

def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries scored by the additive rule: a deterministic score any engine reproduces."""
    probability = scoring.expected_success_prob()
    return deliveries(spark, sf_dir).select(
        LABEL,
        probability.alias("probability"),
        (probability >= RULE_THRESHOLD).cast("int").alias("prediction"),
    )


@query
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Alphabetical codes depend on which values occur, not on how often.
    combinations = deliveries(spark, sf_dir).select(features.CATEGORIES).distinct()
    codes = features.label_encoder().fit(combinations).transform(combinations)
    return codes.select(
        *features.CATEGORIES,
        *[F.col(f"{c}_enc").cast("int").alias(f"{c}_enc") for c in features.CATEGORIES],
    )


@query
def feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled feature vector of every delivery, one column per feature."""
    df = deliveries(spark, sf_dir)
    encoder = features.label_encoder().fit(df.select(features.CATEGORIES).distinct())
    stages = PipelineModel(stages=[features.bucket_stage(), encoder, features.assembler()])
    values = vector_to_array("features")
    return stages.transform(df).select(
        "delivery_id",
        *[values[i].cast("int").alias(name) for i, name in enumerate(FEATURES)],
    )


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = deliveries(spark, sf_dir)
    part = F.when(features.test_condition(attempts), "test").otherwise("train").alias("part")
    return attempts.groupBy(part, LABEL).agg(F.count("*").alias("n"))


@query
def test_part_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries of the test part."""
    return features.split(deliveries(spark, sf_dir))[1].select("delivery_id")


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        metrics.classification_metrics(_rule_scored(spark, sf_dir), threshold=RULE_THRESHOLD),
        "accuracy", "roc_auc",
    )


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_rule_scored(spark, sf_dir))


@query
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        metrics.class_report(_rule_scored(spark, sf_dir)), "precision", "recall", "f1"
    )


_models: dict[tuple[str, str], PipelineModel] = {}


def fitted_forest(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The forest trained on the training part, fitted once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        train_part, _ = features.split(deliveries(spark, sf_dir))
        _models[key] = forest.train(train_part)
    return _models[key]


@query
def rf_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the best single split over all deliveries, both classes weighed alike, predicts for every feature combination."""
    attempts = deliveries(spark, sf_dir)
    model = forest.train(attempts, trees=1, depth=1, bootstrap=False, subset="all", balanced=True)
    cells = forest.feature_cells(attempts).select(features.RAW_FEATURES)
    scored = forest.predict_cells(model, cells)
    return scored.select(*features.RAW_FEATURES, F.round("probability", 9).alias("probability"))


@query
def rf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted_forest(spark, sf_dir)
    scored = forest.predict_by_cell(
        model, deliveries(spark, sf_dir), scratch_dir(spark, "scores")
    )
    return scored.select("delivery_id", "prediction", "probability")


@query
def rf_predictions_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery is scored, by a probability, and its class is the likelier one."""
    scored = rf_predictions(spark, sf_dir)
    p = F.col("probability")
    return scored.select(
        "delivery_id",
        p.between(0, 1).alias("is_probability"),
        ((F.col("prediction") == 1) == (p > 0.5)).alias("is_likelier"),
    )


@query
def rf_test_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class in the test part, as the report of the model counts them."""
    return rf_class_report(spark, sf_dir).where(F.col("class").isin("0", "1")).select("class", "support")


@query
def rf_importance_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importances are shares of one."""
    total = F.round(F.sum("importance"), 6).alias("total")
    sound = F.count_if(F.col("importance") < 0).alias("negative")
    return rf_feature_importance(spark, sf_dir).agg(F.count("*").alias("features"), total, sound)


@query
def what_if_as_is(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left as they are gain nothing."""
    as_is = what_if_uplift(spark, sf_dir).where("scenario = 'as_is'")
    return as_is.select("scenario", F.round("uplift_points", 9).alias("uplift_points"))


@query
def model_reload_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that a saved and loaded model puts into another class."""
    before = rf_predictions(spark, sf_dir).select("delivery_id", F.col("prediction").alias("before"))
    both = before.join(model_roundtrip(spark, sf_dir), "delivery_id")
    changed = F.count_if(F.col("before") != F.col("prediction"))
    return both.agg(F.count("*").alias("deliveries"), changed.alias("changed"))


@query
def rf_node_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature combinations, and how many of them the saved node table scores otherwise than the model."""
    model, path = fitted_forest(spark, sf_dir), scratch_dir(spark, "model")
    forest.save_model(model, path)
    cells = forest.feature_cells(deliveries(spark, sf_dir)).select(features.RAW_FEATURES)
    ours = node_table.score_cells(cells, node_table.node_table(spark, path), node_table.label_table(spark, path))
    both = ours.join(
        forest.predict_cells(model, cells).withColumnRenamed("probability", "theirs"), features.RAW_FEATURES
    )
    far = F.abs(F.col("probability") - F.col("theirs")) > 1e-12
    return both.agg(F.count("*").alias("cells"), F.count_if(far | F.col("probability").isNull()).alias("differ"))


@query
def rf_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and AUC on the held-out part, scored per feature combination."""
    _, test_part = features.split(deliveries(spark, sf_dir))
    cells = forest.feature_cells(test_part, LABEL)
    scored = forest.predict_cells(fitted_forest(spark, sf_dir), cells)
    return metrics.classification_metrics(scored, weight="weight")


@query
def rf_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test_part = features.split(deliveries(spark, sf_dir))
    cells = forest.feature_cells(test_part, LABEL)
    scored = forest.predict_cells(fitted_forest(spark, sf_dir), cells)
    return metrics.class_report(scored, weight="weight")


@query
def rf_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.feature_importance(spark, fitted_forest(spark, sf_dir))


@query
def what_if_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"has_delivery_preference": 1, "proximity_alert_sent": 1}
    return forest.what_if(
        fitted_forest(spark, sf_dir),
        deliveries(spark, sf_dir),
        {
            "preference_and_alert": flags,
            "evening_preference_and_alert": {**flags, "delivery_window": EVENING},
        },
    )


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "model")
    forest.save_model(fitted_forest(spark, sf_dir), path)
    scored = forest.predict_by_cell(
        forest.load_model(path), deliveries(spark, sf_dir), scratch_dir(spark, "scores")
    )
    return scored.select("delivery_id", "prediction")
