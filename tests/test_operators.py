import pytest

from doorstep.operators import counts, dashboard, marts, ranking, rates, staging
from doorstep.schema import DELIVERY_COLUMNS


def by_success(total, successes, **values):
    return [{**values, "is_successful": int(i < successes)} for i in range(total)]


def test_staging_casts_and_drops(spark):
    text = {c: "x" for c in DELIVERY_COLUMNS}
    text |= {
        "order_value": "12.50", "is_successful": "1", "attempt_number": "abc",
        "attempt_hour": "12abc", "has_delivery_preference": "", "proximity_alert_sent": "0",
        "attempt_date": "2024-01-15 08:32:11",
    }
    bad_date = {**text, "delivery_id": "y", "attempt_date": "2024-13-40"}
    no_id = {**text, "delivery_id": None}
    schema = ", ".join(f"{c} string" for c in DELIVERY_COLUMNS)
    raw = spark.createDataFrame(
        [tuple(r[c] for c in DELIVERY_COLUMNS) for r in (text, bad_date, no_id)], schema
    )
    first, second = staging.stage_deliveries(raw).orderBy("delivery_id").collect()
    assert (first.order_value, first.is_successful, first.proximity_alert_sent) == (12.5, 1, 0)
    assert first.attempt_number is first.attempt_hour is first.has_delivery_preference is None
    assert str(first.attempt_date) == "2024-01-15"
    assert second.delivery_id == "y" and second.attempt_date is None


def test_filter_records(attempts):
    df = attempts({"city": "Pune"}, {"city": "Delhi"}, {"city": "Delhi", "is_successful": 0})
    assert staging.filter_records(df, city="Delhi", is_successful=0).count() == 1


def test_overall(attempts, rows):
    df = attempts(*by_success(8, 5))
    assert rows(rates.overall_fadr(df)) == [(8, 5, 62.5, 3, 37.5)]


def test_rates_count_every_attempt_number(attempts, rows):
    df = attempts({"attempt_number": 3, "is_successful": 0}, {"attempt_number": 1})
    assert rows(rates.overall_fadr(df))[0][2] == 50.0


def test_worst_first_with_tie_break(attempts, rows):
    df = attempts(
        *by_success(2, 1, delivery_window="b"),
        *by_success(2, 1, delivery_window="a"),
        *by_success(1, 0, delivery_window="c"),
    )
    assert [r[0] for r in rows(rates.fadr_by_window(df))] == ["c", "a", "b"]


def test_flag_reports_carry_labels(attempts, rows):
    df = attempts({"proximity_alert_sent": 0}, {"proximity_alert_sent": 1, "is_successful": 0})
    assert sorted(rows(rates.fadr_by_alert(df))) == [
        (0, 1, 100.0, "No Alert Sent"), (1, 1, 0.0, "Alert Sent"),
    ]


def test_worst_combinations_threshold_is_strict(attempts, rows):
    df = attempts(
        *by_success(4, 1, address_type="House"), *by_success(3, 0, address_type="Office")
    )
    found = rows(rates.worst_combinations(df, min_attempts=3))
    assert found == [("House", "Evening (15-19)", 4, 25.0)]
    assert len(rows(rates.worst_combinations(df, min_attempts=0, k=1))) == 1


def test_cost(attempts, rows):
    df = attempts(*by_success(5, 2, city="Delhi"), *by_success(4, 3))
    assert rows(rates.cost_of_failure(df, cost=10)) == [("Delhi", 3, 30, 40.0), ("Pune", 1, 10, 75.0)]


def test_null_city_is_a_group_in_reports_but_no_segment(attempts, rows):
    df = attempts({"city": None}, {"city": "Pune", "is_successful": None}, {"city": "Pune"})
    assert {r[0] for r in rows(rates.city_summary(df))} == {None, "Pune"}
    assert rows(marts.fadr_by_segment(df)) == [("Pune", "House", 1, 1, 1.0)]
    totals = {r.city: r.total_attempts for r in marts.mart_city_address(df).collect()}
    assert totals == {None: 1, "Pune": 2}


def test_segment_without_rated_attempts(attempts, rows):
    assert rows(marts.fadr_by_segment(attempts({"is_successful": None}))) == [
        ("Pune", "House", 0, 0, None)
    ]


def test_mart_window_threshold_is_strict(attempts):
    df = attempts(*by_success(50, 10, city="a"), *by_success(51, 10, delivery_window="w"))
    kept = marts.mart_window_alerts(df).collect()
    assert [(r.delivery_window, r.total_attempts, r.fadr) for r in kept] == [("w", 51, 0.1961)]


def test_rank_keeps_ties(attempts, rows):
    df = attempts(
        *by_success(3, 1, address_type="A"),
        *by_success(3, 1, address_type="B"),
        *by_success(3, 2, address_type="C"),
        *by_success(2, 0, address_type="C", city="Delhi"),
    )
    assert rows(ranking.worst_address_per_city(df)) == [
        ("Delhi", "C", 0.0, 1), ("Pune", "A", 33.33, 1), ("Pune", "B", 33.33, 1),
    ]


def test_rank_uses_the_rounded_rate(spark, rows):
    # The two rates differ before rounding to two decimals, not after.
    schema = "city string, address_type string, is_successful int"
    near = [("x", "A", int(i < 10000)) for i in range(30001)]
    nearer = [("x", "B", int(i < 10001)) for i in range(30003)]
    df = spark.createDataFrame(near + nearer, schema)
    assert [r[1] for r in rows(ranking.worst_address_per_city(df))] == ["A", "B"]


def test_shares_and_null_reason(attempts, rows):
    failed = {"is_successful": 0}
    df = attempts(
        {**failed, "failure_reason": "x"}, {**failed, "failure_reason": "x"}, failed, {}
    )
    assert rows(counts.failure_reasons(df)) == [("x", 2, 66.67), (None, 1, 33.33)]
    assert rows(counts.failure_counts(df)) == [("x", 2)]
    assert rows(counts.repeat_attempts(df)) == [(1, 4, 100.0)]
    assert sorted(rows(counts.class_balance(df))) == [(0, 3), (1, 1)]
    assert rows(counts.list_cities(df)) == [("Pune",)]


def test_rate_vs_overall_ignores_unrated(attempts, rows):
    df = attempts(
        *by_success(4, 1, delivery_window="a"),
        *by_success(4, 4, delivery_window="b"),
        {"delivery_window": "b", "is_successful": None},
    )
    assert rows(rates.rate_vs_overall(df)) == [("a", 25.0, 62.5), ("b", 100.0, 62.5)]


def test_cohorts_overlap(attempts, rows):
    office = {"address_type": "Office", "has_delivery_preference": 1}
    df = attempts(
        office, {"is_successful": 0},
        {"address_type": "Apartment", "delivery_window": "Morning (9-12)", "is_successful": 0},
    )
    assert rows(rates.cohort_rates(df)) == [
        ("office_evening_preference", 1, 100.0, 100.0),
        ("any_evening", 2, 50.0, 50.0),
        ("apartment_morning_no_preference", 1, 0.0, 0.0),
    ]


def test_kpis(attempts, rows):
    df = attempts({"attempt_number": 2}, {}, {"is_successful": 0, "attempt_number": 3})
    assert rows(dashboard.kpis(df)) == [(3, 2, 1, 66.7, 33.3, 2, 66.7)]


def test_kpis_of_an_empty_table(attempts, rows):
    assert rows(dashboard.kpis(attempts({}).limit(0))) == [(0, 0, 0, None, None, 0, None)]


def test_heatmap_leaves_missing_pairs_null(attempts, rows):
    df = attempts(
        {"delivery_window": "Morning (9-12)", "is_successful": 0}, {}, {"city": "Delhi"}
    )
    assert rows(dashboard.fadr_heatmap(df, city="Pune")) == [
        ("Pune", "House", 0.0, None, 100.0, None)
    ]
    assert dashboard.fadr_heatmap(df).count() == 2


@pytest.mark.parametrize("current, target", [(70.04, 75.0), (96.0, 99.0)])
def test_savings(spark, current, target):
    df = spark.createDataFrame([("x", current)], "city string, fadr_pct double")
    row = dashboard.savings_scenarios(df, costs=(45,), daily_volume=1000).first()
    now = round(current, 1)
    assert row.target_fadr == pytest.approx(target)
    assert row.daily_savings == pytest.approx((target - now) / 100 * 1000 * 45)
    assert row.annual_savings == pytest.approx(row.daily_savings * 365)


def test_savings_with_a_chosen_target(spark):
    df = spark.createDataFrame([("x", 80.0)], "city string, fadr_pct double")
    found = dashboard.savings_scenarios(df, costs=(10, 20), daily_volume=100, target=90.0)
    assert [round(r.daily_savings) for r in found.orderBy("cost_per_failure").collect()] == [100, 200]


def test_every_address_window_pair_is_reported(attempts):
    rows = [{"address_type": f"a{i}", "delivery_window": f"w{j}"} for i in range(6) for j in range(5)]
    assert rates.fadr_by_address_window(attempts(*rows)).count() == 30


def test_savings_round_the_rate_once(spark):
    rate = spark.createDataFrame([("a", 74.245), ("b", 99.6)], "city string, fadr_pct double")
    got = {r.city: r for r in dashboard.savings_scenarios(rate, daily_volume=100_000).collect()}
    assert got["a"].current_fadr == 74.2 and round(got["a"].current_failures) == 25_800
    assert got["b"].target_fadr == 99.6 and got["b"].annual_savings == 0
    below = dashboard.savings_scenarios(rate, target=50.0).where("city = 'a'").first()
    assert below.daily_savings == 0
