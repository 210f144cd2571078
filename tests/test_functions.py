import json

import pytest
from pyspark.sql import functions as F

from doorstep.functions import labels, scoring, text
from doorstep.schema import STATUS_UPDATE, STATUSES

EDGES = [0.0, 0.01, 499.99, 500.0, 500.01, 1500.0, 1500.01, 3000.0, 3000.01, 10000.0, 10000.01, None]


@pytest.fixture
def values(spark):
    return spark.createDataFrame([(v,) for v in EDGES], "order_value double").coalesce(1)


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_left_closed_labels(values):
    low, second, third, high = "Under 500", "500-1500", "1500-3000", "Above 3000"
    expected = [low] * 3 + [second] * 2 + [third] * 2 + [high] * 5
    assert column(values, labels.value_bucket_labels()) == expected


def test_left_closed_labels_rs(values):
    low, second, third, high = "Under Rs 500", "Rs 500-1500", "Rs 1500-3000", "Above Rs 3000"
    expected = [low] * 3 + [second] * 2 + [third] * 2 + [high] * 5
    assert column(values, labels.value_bucket_labels_rs()) == expected


def test_right_closed_code(values):
    expected = [None, 0, 0, 0, 1, 1, 2, 2, 3, 3, None, None]
    assert column(values, labels.value_bucket_code()) == expected


def test_high_risk_needs_all_three(attempts, rows):
    risky = {"address_type": "PG/Hostel", "delivery_window": "Morning (9-12)"}
    df = attempts(
        risky,
        {**risky, "address_type": "Apartment"},
        {**risky, "address_type": "House"},
        {**risky, "delivery_window": "Night (19-22)"},
        {**risky, "has_delivery_preference": 1},
    )
    result = rows(df.select("delivery_id", labels.high_risk_flag()).orderBy("delivery_id"))
    assert [r[1] for r in result] == [1, 1, 0, 0, 0]


def test_lookup_quotes_and_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string").coalesce(1)
    assert column(df, labels.lookup("k", {"a": "it's"}, "rest")) == ["it's", "rest", "rest"]
    assert column(df, labels.lookup("k", {"a": 1})) == [1, None, None]


def test_flag_label(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "flag int").coalesce(1)
    assert column(df, labels.flag_label("flag", ("off", "on"))) == ["off", "on", None]


def test_status_class(spark):
    df = spark.createDataFrame([(s,) for s in STATUSES], "status string").coalesce(1)
    assert column(df, labels.status_class()) == [
        "in progress", "in progress", "in progress", "success", "unsuccessful", "unsuccessful",
    ]


@pytest.mark.parametrize(
    "address, window, value, points",
    [
        ("House", "Afternoon (12-15)", 5000.0, 7800),
        ("House", "Afternoon (12-15)", 5000.01, 7300),
        ("Apartment", "Morning (9-12)", 6000.0, 4600),
        ("PG/Hostel", "Evening (15-19)", 10.0, 7400),
        ("Office", "Night (19-22)", 10.0, 9700),
        ("Office", "Evening (15-19)", 10.0, 9600),
        ("Elsewhere", "Whenever", 10.0, 7800),
    ],
)
def test_expected_success(attempts, address, window, value, points):
    df = attempts({"address_type": address, "delivery_window": window, "order_value": value})
    assert column(df, scoring.expected_success_bp()) == [points]
    assert column(df, scoring.expected_success_prob()) == [points / 10000]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("Evening (15-19)", "abcdefghij"), ("all day", "abc")], "delivery_window string, id string"
    ).coalesce(1)
    assert column(df, text.window_start_hour()) == [15, None]
    assert column(df, text.id_prefix("id")) == ["abcdefgh", "abc"]


def test_dates_and_rounding(attempts, rows):
    df = attempts({"order_value": 10.25})
    result = df.select(
        text.date_text("attempt_date"),
        text.days_before("attempt_date", 15).cast("string"),
        text.one_decimal("order_value"),
    )
    assert rows(result) == [("2024-01-15", "2023-12-31", 10.3)]


def test_ingest_stamp_is_the_wall_clock(spark):
    seconds = spark.range(1).select(
        F.abs(F.unix_timestamp(text.ingest_stamp()) - F.unix_timestamp(F.current_timestamp()))
    )
    assert seconds.first()[0] <= 1


def test_status_update_payload(attempts):
    df = attempts(
        {"is_successful": 0, "failure_reason": 'Wrong "Address"', "attempt_number": 2}
    )
    payload = column(df, text.status_update_payload())[0]
    assert json.loads(payload) == {
        "delivery_id": "d0",
        "status": "FAILED",
        "reason": 'Wrong "Address"',
        "attempt": 2,
        "partner_id": "c1",
    }
    parsed = df.select(text.status_update_payload().alias("value")).select(
        F.from_json("value", STATUS_UPDATE).alias("u")
    )
    assert parsed.select("u.attempt").first()[0] == 2
