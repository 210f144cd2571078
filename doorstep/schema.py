"""Declared schemas and the fixed values every module shares."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These labels, edges and constants define the data model, so
# results are only comparable when they are exactly these.
# ---------------------------------------------------------------------------
CITIES = ["Mumbai", "Delhi", "Bangalore", "Hyderabad", "Pune", "Chennai"]
ADDRESS_TYPES = ["Apartment", "PG/Hostel", "House", "Office", "Gated Community"]
MORNING, AFTERNOON, EVENING, NIGHT = WINDOWS = [
    "Morning (9-12)",
    "Afternoon (12-15)",
    "Evening (15-19)",
    "Night (19-22)",
]
FAILURE_REASONS = [
    "Customer Unavailable",
    "Wrong Address",
    "Refused Delivery",
    "Building Access Denied",
]
STATUSES = ["PICKED_UP", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "FAILED", "RESCHEDULED"]
TERMINAL_STATUSES = ["DELIVERED", "FAILED", "RESCHEDULED"]

VALUE_EDGES = [500, 1500, 3000]
VALUE_CEILING = 10000
VALUE_LABELS = ["Under 500", "500-1500", "1500-3000", "Above 3000"]
VALUE_LABELS_RS = ["Under Rs 500", "Rs 500-1500", "Rs 1500-3000", "Above Rs 3000"]

HIGH_RISK_ADDRESSES = ["Apartment", "PG/Hostel"]
PREFERENCE_LABELS = ("No Preference Set", "Preference Set")
ALERT_LABELS = ("No Alert Sent", "Alert Sent")

# Success rule in basis points: a base, additive adjustments, and a clamp.
BASE_BP = 7800
ADDRESS_BP = {"Apartment": -1200, "PG/Hostel": -1200, "Office": 1000}
WINDOW_BP = {MORNING: -1500, EVENING: 800, NIGHT: 1200}
HIGH_VALUE, HIGH_VALUE_BP = 5000, -500
MIN_BP, MAX_BP = 1000, 9700

COST_PER_FAILURE = 45
DAILY_VOLUME = 100_000
TARGET_GAIN, TARGET_CAP = 5.0, 99.0
WORST_MIN_ATTEMPTS, WORST_K = 200, 10
MART_MIN_ATTEMPTS = 50
MEAN_RANGE = (0.5, 0.95)

TOPIC = "delivery-events"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

FEATURES = [
    "address_type_enc",
    "delivery_window_enc",
    "city_enc",
    "order_value_bucket",
    "attempt_number",
    "has_delivery_preference",
    "proximity_alert_sent",
]
LABEL = "is_successful"
FOREST = {"numTrees": 100, "maxDepth": 8, "seed": 42}
TEST_SHARE = 0.2
# ---------------------------------------------------------------------------

DELIVERIES = T.StructType(
    [
        T.StructField("delivery_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("address_type", T.StringType(), False),
        T.StructField("delivery_window", T.StringType(), False),
        T.StructField("order_value", T.DoubleType(), False),
        T.StructField("is_successful", T.IntegerType(), False),
        T.StructField("failure_reason", T.StringType(), True),
        T.StructField("attempt_number", T.IntegerType(), False),
        T.StructField("attempt_date", T.DateType(), False),
        T.StructField("attempt_hour", T.IntegerType(), False),
        T.StructField("has_delivery_preference", T.IntegerType(), False),
        T.StructField("proximity_alert_sent", T.IntegerType(), False),
    ]
)
DELIVERY_COLUMNS = DELIVERIES.fieldNames()
# Spark treats nullable=False as advice, so these are enforced as checks.
REQUIRED_COLUMNS = [f.name for f in DELIVERIES if not f.nullable]

EVENT = T.StructType(
    [
        T.StructField("delivery_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("address_type", T.StringType()),
        T.StructField("window", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("order_value", T.DoubleType()),
        T.StructField("attempt", T.IntegerType()),
    ]
)

NARROW_EVENT = T.StructType(
    [
        T.StructField("delivery_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

STATUS_UPDATE = T.StructType(
    [
        T.StructField("delivery_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("partner_id", T.StringType()),
    ]
)
