"""Deliveries and delivery events derived from the star-schema tables.

Orders stand for delivery attempts and ``events`` for the live feed. Every derived value is integer
arithmetic on a key, so any engine gives the same rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from doorstep.functions.labels import lookup
from doorstep.functions.scoring import expected_success_bp
from doorstep.schema import ADDRESS_TYPES, CITIES, FAILURE_REASONS, WINDOWS

SEGMENT_ADDRESS = {
    "AUTOMOBILE": "Apartment",
    "BUILDING": "PG/Hostel",
    "FURNITURE": "House",
    "HOUSEHOLD": "Office",
}
WINDOW_START_HOURS = dict(zip(WINDOWS, [9, 12, 15, 19]))
EVENT_STATUS = {
    "purchase": "DELIVERED",
    "error": "FAILED",
    "signup": "RESCHEDULED",
    "view": "IN_TRANSIT",
    "click": "OUT_FOR_DELIVERY",
}


_schemas: dict[tuple[str, str], T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema; its footers are read for the schema once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def _pick(index: str, values: list[str]) -> Column:
    return lookup(index, dict(enumerate(values)))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery attempt per order, in the declared columns.

    The only large join is orders with customer on the customer key; AQE splits a customer key that
    holds many orders. Each dimension meets the orders by itself, so that the planner goes by the
    size of its files, not by a guess at a join's output: nation and region are always small enough
    to broadcast, customer only while it is below the session's threshold.
    """
    orders, customer, nation, region = (
        read_table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")
    )
    placed = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    rated = placed.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.col("r_name").alias("city"),
        lookup("c_mktsegment", SEGMENT_ADDRESS, "Gated Community").alias("address_type"),
        _pick("quarter(o_orderdate) - 1", WINDOWS).alias("delivery_window"),
        F.expr("round(o_totalprice / 62.5D, 2)").alias("order_value"),
    )
    outcome = rated.withColumns(
        {
            "is_successful": (
                F.expr("(o_orderkey * 7919 + 4729) % 10007") < expected_success_bp()
            ).cast("int"),
            "attempt_draw": F.expr("(o_orderkey * 31 + 17) % 97"),
            "reason": _pick("(o_orderkey * 11 + 3) % 13 % 4", FAILURE_REASONS),
        }
    )
    return outcome.select(
        F.expr("CAST(o_orderkey AS STRING) AS delivery_id"),
        F.expr("CAST(o_custkey AS STRING) AS customer_id"),
        "city",
        "address_type",
        "delivery_window",
        "order_value",
        "is_successful",
        F.expr("CASE WHEN is_successful = 0 THEN reason END AS failure_reason"),
        F.expr(
            "CASE WHEN attempt_draw < 68 THEN 1 WHEN attempt_draw < 89 THEN 2 ELSE 3 END"
            " AS attempt_number"
        ),
        F.expr("CAST(o_orderdate AS DATE) AS attempt_date"),
        lookup("delivery_window", WINDOW_START_HOURS).alias("attempt_hour"),
        F.expr("CAST((o_orderkey * 13 + 5) % 89 < 36 AS INT) AS has_delivery_preference"),
        F.expr("CAST((o_orderkey * 17 + 11) % 101 < 45 AS INT) AS proximity_alert_sent"),
    )


def deliveries_as_text(df: DataFrame) -> DataFrame:
    """The same records as an untyped landing would hold them."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def delivery_events(events: DataFrame) -> DataFrame:
    """Delivery status events from the raw ``events`` rows; works on a batch or a stream."""
    return events.select(
        F.expr("CAST(event_id AS STRING)").alias("delivery_id"),
        _pick("user_id % 6", CITIES).alias("city"),
        _pick("user_id % 5", ADDRESS_TYPES).alias("address_type"),
        _pick("event_id % 4", WINDOWS).alias("window"),
        lookup("event_type", EVENT_STATUS).alias("status"),
        F.expr("CAST(ts AS TIMESTAMP)").alias("timestamp"),
        F.expr("round(150 + value * 16, 2)").alias("order_value"),
        F.expr("CAST(event_id % 3 + 1 AS INT)").alias("attempt"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_events(read_table(spark, sf_dir, "events"))
