import pytest

from doorstep.operators import quality as q


def violations(df, *checks):
    return {(r.check_name, r.column): r.violations for r in q.run_checks(df, list(checks)).collect()}


def test_each_check_fires_once(attempts):
    df = attempts(
        *[{"city": None if i == 0 else "Pune"} for i in range(4)],
        {"is_successful": 2},
        {"failure_reason": "x"},
        {"order_value": 0.0},
        {"address_type": "Castle"},
        {"delivery_id": "d0"},
    )
    found = violations(df, *q.attempt_checks())
    fired = {key for key, n in found.items() if n}
    assert fired == {
        ("not_null", "city"),
        ("unique", "delivery_id"),
        ("accepted_values", "is_successful"),
        ("accepted_values", "address_type"),
        ("positive", "order_value"),
        ("null_when", "failure_reason"),
        ("mean_between", "is_successful"),
    }
    assert all(found[key] == 1 for key in fired)


def test_null_is_no_domain_violation_but_is_not_positive(attempts):
    df = attempts({"is_successful": None, "order_value": None})
    found = violations(df, q.accepted_values("is_successful", [0, 1]), q.positive("order_value"))
    assert list(found.values()) == [0, 1]


def test_unique_counts_keys_and_skips_nulls(attempts):
    df = attempts(
        {"delivery_id": "a"}, {"delivery_id": "a"}, {"delivery_id": "a"},
        {"delivery_id": "b"}, {"delivery_id": "b"}, {"delivery_id": None}, {"delivery_id": None},
    )
    assert violations(df, q.unique("delivery_id")) == {("unique", "delivery_id"): 2}
    assert violations(df, q.unique("city", "address_type")) == {("unique", "city,address_type"): 1}


def test_shape_and_mean(attempts):
    df = attempts({}, {}, {"is_successful": 0})
    found = violations(
        df, q.row_count(3), q.column_count(13), q.mean_between("is_successful", 0.5, 0.95)
    )
    assert set(found.values()) == {0}
    assert set(violations(df, q.row_count(4), q.column_count(12)).values()) == {1}
    open_range = violations(attempts({}, {"is_successful": 0}), q.mean_between("is_successful", 0.5, 1))
    assert set(open_range.values()) == {1}


def test_empty_table(attempts):
    empty = attempts({}).limit(0)
    found = violations(empty, q.not_empty(), q.mean_between("is_successful", 0, 1), q.not_null("city"))
    assert list(found.values()) == [1, 1, 0]


def test_assert_checks_lists_failures(attempts):
    df = attempts({"city": None}, {"is_successful": 5})
    report = q.run_checks(df, [q.not_null("city"), q.not_empty(), q.accepted_values("is_successful", [0, 1])])
    with pytest.raises(q.QualityError) as error:
        q.assert_checks(report)
    assert "not_null(city): 1" in str(error.value)
    assert "accepted_values(is_successful): 1" in str(error.value)
    assert "not_empty" not in str(error.value)
    q.assert_checks(q.run_checks(attempts({}), [q.not_empty()]))
