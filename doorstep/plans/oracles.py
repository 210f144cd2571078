"""DuckDB SQL with the same result as each registered query, used to check it."""

from doorstep.schema import (
    ADDRESS_TYPES,
    CITIES,
    DELIVERIES,
    MEAN_RANGE,
    REQUIRED_COLUMNS,
    WINDOWS,
)

# The deliveries derived from the star schema. Basis points: see the success rule in the schema.
DELIVERIES_SQL = """
WITH placed AS (
    SELECT
        o_orderkey AS k,
        o_custkey,
        o_orderdate,
        r_name AS city,
        CASE c_mktsegment
            WHEN 'AUTOMOBILE' THEN 'Apartment'
            WHEN 'BUILDING' THEN 'PG/Hostel'
            WHEN 'FURNITURE' THEN 'House'
            WHEN 'HOUSEHOLD' THEN 'Office'
            ELSE 'Gated Community'
        END AS address_type,
        CASE EXTRACT(QUARTER FROM o_orderdate)
            WHEN 1 THEN 'Morning (9-12)'
            WHEN 2 THEN 'Afternoon (12-15)'
            WHEN 3 THEN 'Evening (15-19)'
            ELSE 'Night (19-22)'
        END AS delivery_window,
        ROUND(o_totalprice / 62.5e0, 2) AS order_value
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
), scored AS (
    SELECT *,
        LEAST(9700, GREATEST(1000,
            7800
            + CASE WHEN address_type IN ('Apartment', 'PG/Hostel') THEN -1200
                   WHEN address_type = 'Office' THEN 1000 ELSE 0 END
            + CASE delivery_window WHEN 'Morning (9-12)' THEN -1500
                   WHEN 'Evening (15-19)' THEN 800
                   WHEN 'Night (19-22)' THEN 1200 ELSE 0 END
            + CASE WHEN order_value > 5000 THEN -500 ELSE 0 END)) AS expected_bp
    FROM placed
), outcome AS (
    SELECT *, CAST((k * 7919 + 4729) % 10007 < expected_bp AS INTEGER) AS is_successful
    FROM scored
), d AS (
    SELECT
        CAST(k AS VARCHAR) AS delivery_id,
        CAST(o_custkey AS VARCHAR) AS customer_id,
        city,
        address_type,
        delivery_window,
        order_value,
        is_successful,
        CASE WHEN is_successful = 0 THEN
            CASE (k * 11 + 3) % 13 % 4
                WHEN 0 THEN 'Customer Unavailable'
                WHEN 1 THEN 'Wrong Address'
                WHEN 2 THEN 'Refused Delivery'
                ELSE 'Building Access Denied'
            END
        END AS failure_reason,
        CAST(CASE WHEN (k * 31 + 17) % 97 < 68 THEN 1
                  WHEN (k * 31 + 17) % 97 < 89 THEN 2 ELSE 3 END AS INTEGER) AS attempt_number,
        CAST(o_orderdate AS DATE) AS attempt_date,
        CAST(CASE delivery_window WHEN 'Morning (9-12)' THEN 9
                  WHEN 'Afternoon (12-15)' THEN 12
                  WHEN 'Evening (15-19)' THEN 15 ELSE 19 END AS INTEGER) AS attempt_hour,
        CAST((k * 13 + 5) % 89 < 36 AS INTEGER) AS has_delivery_preference,
        CAST((k * 17 + 11) % 101 < 45 AS INTEGER) AS proximity_alert_sent,
        expected_bp / 10000e0 AS expected_prob
    FROM outcome
)
"""

EVENTS_SQL = """
WITH e AS (
    SELECT
        CAST(event_id AS VARCHAR) AS delivery_id,
        CASE user_id % 6 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Delhi' WHEN 2 THEN 'Bangalore'
            WHEN 3 THEN 'Hyderabad' WHEN 4 THEN 'Pune' ELSE 'Chennai' END AS city,
        CASE user_id % 5 WHEN 0 THEN 'Apartment' WHEN 1 THEN 'PG/Hostel' WHEN 2 THEN 'House'
            WHEN 3 THEN 'Office' ELSE 'Gated Community' END AS address_type,
        CASE event_id % 4 WHEN 0 THEN 'Morning (9-12)' WHEN 1 THEN 'Afternoon (12-15)'
            WHEN 2 THEN 'Evening (15-19)' ELSE 'Night (19-22)' END AS "window",
        CASE event_type WHEN 'purchase' THEN 'DELIVERED' WHEN 'error' THEN 'FAILED'
            WHEN 'signup' THEN 'RESCHEDULED' WHEN 'view' THEN 'IN_TRANSIT'
            WHEN 'click' THEN 'OUT_FOR_DELIVERY' END AS status,
        ts AS "timestamp",
        ROUND(150 + value * 16, 2) AS order_value,
        CAST(event_id % 3 + 1 AS INTEGER) AS attempt
    FROM events
)
"""

COLUMNS = ", ".join(DELIVERIES.fieldNames())
FADR = "ROUND(AVG(is_successful) * 100, 2)"
FAILED = "CAST(SUM(1 - is_successful) AS BIGINT)"
SUCCESSFUL = "CAST(SUM(is_successful) AS BIGINT)"
RULE_PREDICTION = "CAST(expected_prob >= 0.75e0 AS INTEGER)"


def _rates(keys: str, count: str = "total_attempts", rate: str = "fadr_percent") -> str:
    return f"SELECT {keys}, COUNT(*) AS {count}, {FADR} AS {rate} FROM d GROUP BY {keys}"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _load_report() -> str:
    fields = ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in DELIVERIES)
    return (
        "SELECT column_name, data_type, (SELECT COUNT(*) FROM d) AS rows"
        f" FROM (VALUES {fields}) AS t(column_name, data_type)"
    )


def _quality_report() -> str:
    def violating(condition: str) -> str:
        return f"(SELECT COUNT(*) FROM d WHERE {condition})"

    low, high = MEAN_RANGE
    checks = [("not_null", c, violating(f"{c} IS NULL")) for c in REQUIRED_COLUMNS]
    checks += [
        ("accepted_values", flag, violating(f"{flag} NOT IN (0, 1)"))
        for flag in ("is_successful", "has_delivery_preference", "proximity_alert_sent")
    ]
    checks += [
        ("accepted_values", "address_type", violating(f"address_type NOT IN ({_quoted(ADDRESS_TYPES)})")),
        (
            "accepted_values",
            "delivery_window",
            violating(f"delivery_window NOT IN ({_quoted(WINDOWS)})"),
        ),
        ("accepted_values", "city", violating(f"city NOT IN ({_quoted(CITIES)})")),
        ("positive", "order_value", violating("order_value IS NULL OR order_value <= 0")),
        ("null_when", "failure_reason", violating("is_successful = 1 AND failure_reason IS NOT NULL")),
        (
            "unique",
            "delivery_id",
            "(SELECT COUNT(*) FROM (SELECT delivery_id FROM d WHERE delivery_id IS NOT NULL"
            " GROUP BY delivery_id HAVING COUNT(*) > 1))",
        ),
        (
            "mean_between",
            "is_successful",
            f"(SELECT CASE WHEN AVG(is_successful) > {low} AND AVG(is_successful) < {high}"
            " THEN 0 ELSE 1 END FROM d)",
        ),
        ("column_count", "*", "0"),
        ("not_empty", "*", "(SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM d)"),
        (
            "row_count",
            "*",
            "(SELECT CASE WHEN COUNT(*) = (SELECT COUNT(*) FROM orders) THEN 0 ELSE 1 END FROM d)",
        ),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{column}' AS \"column\","
        f" CAST({count} AS BIGINT) AS violations"
        for name, column, count in checks
    )
    return f"SELECT *, violations = 0 AS passed FROM ({rows})"


def _cohorts() -> str:
    members = {
        "office_evening_preference": "address_type = 'Office' AND delivery_window ="
        " 'Evening (15-19)' AND has_delivery_preference = 1",
        "any_evening": "delivery_window = 'Evening (15-19)'",
        "apartment_morning_no_preference": "address_type = 'Apartment' AND delivery_window ="
        " 'Morning (9-12)' AND has_delivery_preference = 0",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS cohort, COUNT(*) AS attempts, {FADR} AS fadr_pct FROM d WHERE {where}"
        for name, where in members.items()
    )
    return (
        "SELECT *, ROUND(fadr_pct - MIN(fadr_pct) OVER (), 2) AS points_above_worst"
        f" FROM ({rows})"
    )


def _heatmap(keys: str, where: str = "") -> str:
    windows = {
        "morning": "Morning (9-12)",
        "afternoon": "Afternoon (12-15)",
        "evening": "Evening (15-19)",
        "night": "Night (19-22)",
    }
    cells = ", ".join(
        f"ROUND(AVG(is_successful) FILTER (WHERE delivery_window = '{w}') * 100, 6) AS {name}"
        for name, w in windows.items()
    )
    return f"SELECT {keys}, {cells} FROM d {where} GROUP BY {keys}"


def _class_report() -> str:
    return f"""
, p AS (SELECT is_successful AS y, {RULE_PREDICTION} AS z FROM d),
n AS (SELECT
    COUNT(*) FILTER (WHERE y = 0 AND z = 0) AS tn, COUNT(*) FILTER (WHERE y = 0 AND z = 1) AS fp,
    COUNT(*) FILTER (WHERE y = 1 AND z = 0) AS fn, COUNT(*) FILTER (WHERE y = 1 AND z = 1) AS tp
    FROM p),
c AS (
    SELECT '0' AS class, COALESCE(tn * 1e0 / NULLIF(tn + fn, 0), 0) AS precision,
        COALESCE(tn * 1e0 / NULLIF(tn + fp, 0), 0) AS recall,
        COALESCE(2e0 * tn / NULLIF(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM n
    UNION ALL
    SELECT '1', COALESCE(tp * 1e0 / NULLIF(tp + fp, 0), 0),
        COALESCE(tp * 1e0 / NULLIF(tp + fn, 0), 0),
        COALESCE(2e0 * tp / NULLIF(2 * tp + fn + fp, 0), 0), tp + fn FROM n),
r AS (
    SELECT class, precision, recall, f1, support FROM c
    UNION ALL
    SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support) FROM c
    UNION ALL
    SELECT 'weighted avg', SUM(precision * support) / SUM(support),
        SUM(recall * support) / SUM(support), SUM(f1 * support) / SUM(support), SUM(support) FROM c)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
    CAST(support AS BIGINT) AS support FROM r"""


SEGMENT = f"""SELECT city, address_type, COUNT(is_successful) AS total_attempts,
    {SUCCESSFUL} AS successful, SUM(is_successful) * 1e0 / COUNT(is_successful) AS fadr
FROM d WHERE city IS NOT NULL AND address_type IS NOT NULL GROUP BY city, address_type"""

EVENT_COLUMNS = 'delivery_id, city, address_type, "window", status, "timestamp", order_value, attempt'

PARTS = """, parts AS (
    SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY is_successful ORDER BY MD5(delivery_id), delivery_id)
            <= FLOOR(COUNT(*) OVER (PARTITION BY is_successful) * 2e-1 + 5e-1)
        THEN 'test' ELSE 'train' END AS part FROM d)"""

# A name orders its categories by their success rate, a number by its value.
SPLIT_FEATURES = {
    "address_type": "rate",
    "delivery_window": "rate",
    "city": "rate",
    "order_value_bucket": "CAST(value AS DOUBLE)",
    "attempt_number": "CAST(value AS DOUBLE)",
    "has_delivery_preference": "CAST(value AS DOUBLE)",
    "proximity_alert_sent": "CAST(value AS DOUBLE)",
}
CELL_KEYS = (
    "city, address_type, delivery_window, has_delivery_preference, proximity_alert_sent, value_bucket, attempt_number"
)
VALUE_BUCKET = """CASE WHEN order_value < 500 THEN 'Under Rs 500' WHEN order_value < 1500 THEN 'Rs 500-1500'
    WHEN order_value < 3000 THEN 'Rs 1500-3000' ELSE 'Above Rs 3000' END"""
FIRST_SPLIT = f"""
, cells AS (
    SELECT address_type, delivery_window, city,
        CAST(CASE WHEN order_value <= 500 THEN 0 WHEN order_value <= 1500 THEN 1
            WHEN order_value <= 3000 THEN 2 ELSE 3 END AS INTEGER) AS order_value_bucket,
        attempt_number, has_delivery_preference, proximity_alert_sent,
        SUM(w) AS n, SUM(is_successful * w) AS pos
    FROM (SELECT *, COUNT(*) OVER () / (2e0 * COUNT(*) OVER (PARTITION BY is_successful)) AS w FROM d) GROUP BY ALL
), counted AS (
    SELECT feature, value, SUM(n) AS n, SUM(pos) AS pos, SUM(pos) / SUM(n) AS rate FROM (
        {" UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, n, pos FROM cells" for f in SPLIT_FEATURES)})
    GROUP BY feature, value
), ordered AS (
    SELECT *, CASE feature {" ".join(f"WHEN '{f}' THEN {place}" for f, place in SPLIT_FEATURES.items())} END AS place
    FROM counted
), prefixes AS (
    SELECT feature, value, SUM(n) OVER upto AS ln, SUM(pos) OVER upto AS lp,
        SUM(n) OVER (PARTITION BY feature) AS an, SUM(pos) OVER (PARTITION BY feature) AS ap,
        ROW_NUMBER() OVER upto AS nth
    FROM ordered WINDOW upto AS (PARTITION BY feature ORDER BY place, value)
), best AS (
    SELECT feature AS chosen, nth AS cut, lp / ln AS left_rate, (ap - lp) / (an - ln) AS right_rate
    FROM prefixes WHERE an > ln
    ORDER BY lp * (ln - lp) / ln + (ap - lp) * (an - ln - ap + lp) / (an - ln), feature LIMIT 1
)
SELECT {", ".join(SPLIT_FEATURES)}, ROUND(CASE WHEN nth <= cut THEN left_rate ELSE right_rate END, 9) AS probability
FROM cells, best, prefixes
WHERE feature = chosen
    AND value = CASE chosen {" ".join(f"WHEN '{f}' THEN CAST({f} AS VARCHAR)" for f in SPLIT_FEATURES)} END"""

_ON_DELIVERIES = {
    "overall_fadr": f"""SELECT COUNT(*) AS total_attempts, {SUCCESSFUL} AS successful,
        {FADR} AS fadr_percent, {FAILED} AS failed,
        ROUND(AVG(1 - is_successful) * 100, 2) AS failure_rate_percent FROM d""",
    "fadr_by_window": _rates("delivery_window") + " ORDER BY fadr_percent, delivery_window",
    "fadr_by_address": _rates("address_type") + " ORDER BY fadr_percent, address_type",
    "fadr_by_preference": f"""SELECT *, CASE has_delivery_preference
        WHEN 0 THEN 'No Preference Set' WHEN 1 THEN 'Preference Set' END AS label
        FROM ({_rates("has_delivery_preference")})""",
    "fadr_by_alert": f"""SELECT *, CASE proximity_alert_sent
        WHEN 0 THEN 'No Alert Sent' WHEN 1 THEN 'Alert Sent' END AS label
        FROM ({_rates("proximity_alert_sent")})""",
    "fadr_by_value_bucket": f"""SELECT CASE WHEN order_value < 500 THEN 'Under Rs 500'
            WHEN order_value < 1500 THEN 'Rs 500-1500'
            WHEN order_value < 3000 THEN 'Rs 1500-3000' ELSE 'Above Rs 3000' END AS value_bucket,
        COUNT(*) AS total_attempts, {FADR} AS fadr_percent
        FROM d GROUP BY 1 ORDER BY fadr_percent, value_bucket""",
    "report_cells": f"""SELECT {CELL_KEYS}, failure_reason, is_successful, COUNT(*) AS attempts,
        COUNT(order_value) AS valued, ROUND(SUM(order_value), 2) AS order_value
        FROM (SELECT *, {VALUE_BUCKET} AS value_bucket FROM d) GROUP BY ALL""",
    "rates_at_levels": f"""SELECT {CELL_KEYS}, GROUPING({CELL_KEYS}) AS level, COUNT(*) AS total_attempts,
        {FADR} AS fadr_percent FROM (SELECT *, {VALUE_BUCKET} AS value_bucket FROM d)
        GROUP BY GROUPING SETS ((), {", ".join(f"({k})" for k in CELL_KEYS.split(", "))}, (city, address_type),
            (city, delivery_window), (address_type, delivery_window))""",
    "fadr_by_address_window": _rates("address_type, delivery_window", "attempts", "fadr_pct")
    + " ORDER BY fadr_pct, address_type, delivery_window",
    "worst_combinations": _rates("address_type, delivery_window")
    + " HAVING COUNT(*) > 200 ORDER BY fadr_percent, address_type, delivery_window LIMIT 10",
    "high_risk_cohort": f"""SELECT CAST(address_type IN ('Apartment', 'PG/Hostel')
            AND delivery_window = 'Morning (9-12)' AND has_delivery_preference = 0 AS INTEGER)
            AS is_high_risk,
        COUNT(*) AS count, {FADR} AS fadr_pct FROM d GROUP BY 1""",
    "cost_of_failure": f"""SELECT city, {FAILED} AS failed_deliveries,
        {FAILED} * 45 AS estimated_cost_inr, {FADR} AS fadr_percent
        FROM d GROUP BY city ORDER BY estimated_cost_inr DESC, city""",
    "city_summary": _rates("city", "attempts", "fadr_pct"),
    "rate_vs_overall": f"""SELECT delivery_window, {FADR} AS fadr_pct,
        (SELECT {FADR} FROM d) AS overall_pct
        FROM d GROUP BY delivery_window ORDER BY fadr_pct, delivery_window""",
    "cohort_rates": _cohorts(),
    "failure_reasons": """SELECT failure_reason, COUNT(*) AS count,
        ROUND(COUNT(*) * 100e0 / (SELECT COUNT(*) FROM d WHERE is_successful = 0), 2)
            AS pct_of_failures
        FROM d WHERE is_successful = 0 GROUP BY failure_reason ORDER BY count DESC, 1""",
    "repeat_attempts": """SELECT attempt_number, COUNT(*) AS deliveries,
        ROUND(COUNT(*) * 100e0 / (SELECT COUNT(*) FROM d), 2) AS pct_of_total
        FROM d GROUP BY attempt_number ORDER BY attempt_number""",
    "failure_counts": """SELECT failure_reason, COUNT(*) AS count FROM d
        WHERE is_successful = 0 AND failure_reason IS NOT NULL
        GROUP BY failure_reason ORDER BY count DESC, 1""",
    "class_balance": "SELECT is_successful, COUNT(*) AS count FROM d GROUP BY is_successful",
    "list_cities": "SELECT DISTINCT city FROM d ORDER BY city",
    "fadr_by_segment": SEGMENT,
    "mart_window_alerts": """SELECT delivery_window, address_type, has_delivery_preference,
        proximity_alert_sent, COUNT(*) AS total_attempts, ROUND(AVG(is_successful), 4) AS fadr
        FROM d GROUP BY ALL HAVING COUNT(*) > 50""",
    "worst_address_per_city": f"""SELECT city, address_type, fadr_pct,
            CAST(rank_in_city AS INTEGER) AS rank_in_city
        FROM (SELECT *, RANK() OVER (PARTITION BY city ORDER BY fadr_pct) AS rank_in_city
            FROM (SELECT city, address_type, {FADR} AS fadr_pct FROM d GROUP BY ALL))
        WHERE rank_in_city = 1 ORDER BY fadr_pct, city, address_type""",
    "kpis": f"""SELECT COUNT(*) AS total_attempts, COALESCE({SUCCESSFUL}, 0) AS successful,
        COUNT(*) - COALESCE({SUCCESSFUL}, 0) AS failed,
        ROUND(SUM(is_successful) * 100e0 / COUNT(*), 1) AS fadr_pct,
        ROUND((COUNT(*) - SUM(is_successful)) * 100e0 / COUNT(*), 1) AS failed_pct,
        COUNT(*) FILTER (WHERE attempt_number > 1) AS repeat_attempts,
        ROUND(COUNT(*) FILTER (WHERE attempt_number > 1) * 100e0 / COUNT(*), 1) AS repeat_pct
        FROM d""",
    "mart_city_address": f"""SELECT city, address_type, COUNT(*) AS total_attempts,
        {SUCCESSFUL} AS successful_deliveries, ROUND(AVG(is_successful), 4) AS fadr,
        ROUND(AVG(1 - is_successful), 4) AS failure_rate,
        ROUND(AVG(order_value), 6) AS avg_order_value FROM d GROUP BY city, address_type""",
    "fadr_heatmap": _heatmap("city, address_type"),
    "fadr_heatmap_one_city": _heatmap("address_type", "WHERE city = 'ASIA'"),
    "savings_scenarios": f"""
, r AS (SELECT city, ROUND(AVG(is_successful) * 100, 1) AS current_fadr FROM d GROUP BY city),
s AS (SELECT city, 100000 AS daily_volume, cost_per_failure, current_fadr,
        GREATEST(LEAST(current_fadr + 5.0e0, 99.0e0), current_fadr) AS target_fadr
    FROM r, (VALUES (30), (45), (60)) AS c(cost_per_failure)),
f AS (SELECT *, daily_volume * (1 - current_fadr / 100e0) AS now,
        daily_volume * (1 - target_fadr / 100e0) AS later FROM s)
SELECT city, CAST(daily_volume AS BIGINT) AS daily_volume,
    CAST(cost_per_failure AS INTEGER) AS cost_per_failure,
    current_fadr, ROUND(target_fadr, 6) AS target_fadr,
    ROUND(now, 6) AS current_failures, ROUND(later, 6) AS target_failures,
    ROUND((now - later) * cost_per_failure, 6) AS daily_savings,
    ROUND((now - later) * cost_per_failure * 365, 6) AS annual_savings
FROM f""",
    "stage_deliveries": f"SELECT {COLUMNS} FROM d WHERE delivery_id IS NOT NULL",
    "value_bucket_labels": """SELECT delivery_id, order_value,
        CASE WHEN order_value < 500 THEN 'Under 500' WHEN order_value < 1500 THEN '500-1500'
            WHEN order_value < 3000 THEN '1500-3000' ELSE 'Above 3000' END AS order_value_bucket
        FROM d""",
    "value_bucket_labels_rs": """SELECT delivery_id, order_value,
        CASE WHEN order_value < 500 THEN 'Under Rs 500' WHEN order_value < 1500 THEN 'Rs 500-1500'
            WHEN order_value < 3000 THEN 'Rs 1500-3000' ELSE 'Above Rs 3000' END AS value_bucket
        FROM d""",
    "value_bucket_code": """SELECT delivery_id, order_value, CAST(CASE
            WHEN order_value > 0 AND order_value <= 500 THEN 0
            WHEN order_value > 500 AND order_value <= 1500 THEN 1
            WHEN order_value > 1500 AND order_value <= 3000 THEN 2
            WHEN order_value > 3000 AND order_value <= 10000 THEN 3 END AS INTEGER)
            AS order_value_bucket FROM d""",
    "high_risk_flag": """SELECT delivery_id, CAST(address_type IN ('Apartment', 'PG/Hostel')
        AND delivery_window = 'Morning (9-12)' AND has_delivery_preference = 0 AS INTEGER)
        AS is_high_risk FROM d""",
    "expected_success_prob": "SELECT delivery_id, expected_prob FROM d",
    "scalar_projection": """SELECT delivery_id, 1 - is_successful AS is_failure,
        attempt_hour AS window_start_hour, SUBSTRING(customer_id, 1, 8) AS customer_prefix,
        STRFTIME(attempt_date, '%Y-%m-%d') AS attempt_date_text,
        CAST(attempt_date - INTERVAL 1 DAY AS DATE) AS prev_date,
        ROUND(order_value, 1) AS value_1dp FROM d""",
    "retried_homes": """SELECT delivery_id FROM d WHERE attempt_number > 1
        AND address_type IN ('Apartment', 'PG/Hostel', 'House')""",
    "status_update_payload": """SELECT delivery_id, '{"delivery_id":"' || delivery_id
        || '","status":"FAILED","reason":"' || failure_reason || '","attempt":' || attempt_number
        || ',"partner_id":"' || customer_id || '"}' AS payload FROM d WHERE is_successful = 0""",
    "csv_roundtrip": f"SELECT {COLUMNS} FROM d",
    "load_report": _load_report(),
    "json_records": "SELECT delivery_id, city, is_successful FROM d WHERE city = 'ASIA'",
    "json_array": f"SELECT {COLUMNS} FROM d",
    "table_reload": "SELECT city, COUNT(*) AS n FROM d GROUP BY city",
    "parquet_roundtrip": f"SELECT {COLUMNS} FROM d",
    "featured_partitions": """SELECT delivery_id, city,
        CASE WHEN order_value < 500 THEN 'Under 500' WHEN order_value < 1500 THEN '500-1500'
            WHEN order_value < 3000 THEN '1500-3000' ELSE 'Above 3000' END AS order_value_bucket,
        CAST(address_type IN ('Apartment', 'PG/Hostel') AND delivery_window = 'Morning (9-12)'
            AND has_delivery_preference = 0 AS INTEGER) AS is_high_risk
        FROM d""",
    "export_mart": SEGMENT,
    "daily_job_marts": SEGMENT,
    "daily_city_mart": """SELECT city, address_type, COUNT(*) AS total_attempts,
        CAST(SUM(is_successful) AS BIGINT) AS successful_deliveries, ROUND(AVG(is_successful), 4) AS fadr,
        ROUND(AVG(1 - is_successful), 4) AS failure_rate,
        ROUND(AVG(order_value), 6) AS avg_order_value FROM d GROUP BY city, address_type""",
    "daily_window_mart": """SELECT delivery_window, address_type, has_delivery_preference,
        proximity_alert_sent, COUNT(*) AS total_attempts, ROUND(AVG(is_successful), 4) AS fadr
        FROM d GROUP BY ALL HAVING COUNT(*) > 50""",
    "quality_report": _quality_report(),
    "csv_inferred": """SELECT CAST(delivery_id AS INTEGER) AS delivery_id, city, order_value, attempt_date,
        is_successful FROM d""",
    "csv_reordered": f"SELECT {COLUMNS} FROM d",
    "csv_rejects": """SELECT delivery_id, CONCAT_WS('; ',
            CASE WHEN k % 13 = 0 THEN 'city is missing' END,
            CASE WHEN k % 7 = 0 THEN 'order_value does not parse' END,
            CASE WHEN k % 11 = 0 THEN 'attempt_date does not parse' END) AS reason
        FROM (SELECT *, CAST(delivery_id AS BIGINT) AS k FROM d)
        WHERE k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0""",
    "cached_scan": """SELECT city AS key, COUNT(*) AS n FROM d GROUP BY city
        UNION ALL SELECT CAST(is_successful AS VARCHAR), COUNT(*) FROM d GROUP BY is_successful""",
    "rf_predictions_sound": "SELECT delivery_id, TRUE AS is_probability, TRUE AS is_likelier FROM d",
    "rf_test_support": f"""{PARTS} SELECT CAST(is_successful AS VARCHAR) AS class, COUNT(*) AS support FROM parts
        WHERE part = 'test' GROUP BY is_successful""",
    "rf_first_split": FIRST_SPLIT,
    "rf_node_scores": """SELECT COUNT(*) AS cells, CAST(0 AS BIGINT) AS differ FROM (
        SELECT DISTINCT address_type, delivery_window, city, attempt_number, has_delivery_preference,
            proximity_alert_sent, CASE WHEN order_value <= 500 THEN 0 WHEN order_value <= 1500 THEN 1
            WHEN order_value <= 3000 THEN 2 ELSE 3 END AS bucket FROM d)""",
    "rf_importance_total": """SELECT CAST(7 AS BIGINT) AS features, 1e0 AS total,
        CAST(0 AS BIGINT) AS negative""",
    "what_if_as_is": "SELECT 'as_is' AS scenario, 0e0 AS uplift_points",
    "model_reload_changes": "SELECT COUNT(*) AS deliveries, CAST(0 AS BIGINT) AS changed FROM d",
    "label_encode": """SELECT DISTINCT address_type, delivery_window, city,
        CAST(DENSE_RANK() OVER (ORDER BY address_type) - 1 AS INTEGER) AS address_type_enc,
        CAST(DENSE_RANK() OVER (ORDER BY delivery_window) - 1 AS INTEGER) AS delivery_window_enc,
        CAST(DENSE_RANK() OVER (ORDER BY city) - 1 AS INTEGER) AS city_enc FROM d""",
    "feature_columns": """SELECT delivery_id,
        CAST(DENSE_RANK() OVER (ORDER BY address_type) - 1 AS INTEGER) AS address_type_enc,
        CAST(DENSE_RANK() OVER (ORDER BY delivery_window) - 1 AS INTEGER) AS delivery_window_enc,
        CAST(DENSE_RANK() OVER (ORDER BY city) - 1 AS INTEGER) AS city_enc,
        CAST(CASE WHEN order_value <= 500 THEN 0 WHEN order_value <= 1500 THEN 1
            WHEN order_value <= 3000 THEN 2 ELSE 3 END AS INTEGER) AS order_value_bucket,
        attempt_number, has_delivery_preference, proximity_alert_sent FROM d""",
    "train_test_split": f"{PARTS} SELECT part, is_successful, COUNT(*) AS n FROM parts GROUP BY ALL",
    "test_part_ids": f"{PARTS} SELECT delivery_id FROM parts WHERE part = 'test'",
    "classification_metrics": f"""
, g AS (SELECT expected_prob AS score, COUNT(*) FILTER (WHERE is_successful = 1) AS pos,
        COUNT(*) FILTER (WHERE is_successful = 0) AS neg FROM d GROUP BY expected_prob),
w AS (SELECT *, SUM(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT (SELECT ROUND(AVG(CAST({RULE_PREDICTION} = is_successful AS INTEGER)), 6) FROM d)
        AS accuracy,
    ROUND(CAST(SUM(pos * (below + neg / 2e0)) AS DOUBLE)
        / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 6) AS roc_auc
FROM w""",
    "confusion_matrix": f"""SELECT is_successful AS actual,
        COUNT(*) FILTER (WHERE {RULE_PREDICTION} = 0) AS predicted_0,
        COUNT(*) FILTER (WHERE {RULE_PREDICTION} = 1) AS predicted_1
        FROM d GROUP BY is_successful""",
    "class_report": _class_report(),
}

_ON_EVENTS = {
    "status_class": """SELECT delivery_id, status, CASE WHEN status = 'DELIVERED' THEN 'success'
        WHEN status IN ('FAILED', 'RESCHEDULED') THEN 'unsuccessful'
        ELSE 'in progress' END AS status_class FROM e""",
    "event_encode": """SELECT city AS key, CAST(to_json({
        'delivery_id': delivery_id, 'city': city, 'address_type': address_type,
        'window': "window", 'status': status,
        'timestamp': STRFTIME("timestamp", '%Y-%m-%dT%H:%M:%S.%f'),
        'order_value': order_value, 'attempt': attempt}) AS VARCHAR) AS value FROM e""",
    "event_decode": f"SELECT {EVENT_COLUMNS} FROM e",
    "event_decode_narrow": 'SELECT delivery_id, city, status, "timestamp" FROM e',
    "event_append": f"SELECT {EVENT_COLUMNS} FROM e",
    "live_fadr": """SELECT
        ROUND(AVG(CASE WHEN status = 'DELIVERED' THEN 1e0 ELSE 0e0 END) * 100, 1) AS live_fadr_pct,
        COUNT(*) AS terminal_events
        FROM e WHERE status IN ('DELIVERED', 'FAILED', 'RESCHEDULED')""",
    "event_malformed": """SELECT SUBSTRING(value, 1, 40) AS value FROM (
        SELECT city, CAST(to_json({
            'delivery_id': delivery_id, 'city': city, 'address_type': address_type,
            'window': "window", 'status': status,
            'timestamp': STRFTIME("timestamp", '%Y-%m-%dT%H:%M:%S.%f'),
            'order_value': order_value, 'attempt': attempt}) AS VARCHAR) AS value FROM e)
        WHERE city = 'Pune'""",
    "event_late": """SELECT city, status, COUNT(*) * CASE WHEN city IN ('Delhi', 'Mumbai') THEN 2 ELSE 1 END
        AS n FROM e GROUP BY city, status""",
    "consumer_rate": """SELECT
        ROUND(AVG(CASE WHEN status = 'DELIVERED' THEN 1e0 ELSE 0e0 END)
            FILTER (WHERE status IN ('DELIVERED', 'FAILED', 'RESCHEDULED')) * 100, 1) AS live_fadr_pct,
        2 * COUNT(*) FILTER (WHERE status IN ('DELIVERED', 'FAILED', 'RESCHEDULED')) AS terminal_events,
        2 * COUNT(*) AS events FROM e""",
    "event_consumed_at": "SELECT delivery_id, TRUE AS stamped FROM e",
    "event_publish": """SELECT CAST(to_json({
        'delivery_id': delivery_id, 'city': city, 'address_type': address_type,
        'window': "window", 'status': status,
        'timestamp': STRFTIME("timestamp", '%Y-%m-%dT%H:%M:%S.%f'),
        'order_value': order_value, 'attempt': attempt}) AS VARCHAR) AS value FROM e""",
    "event_dedup": "SELECT status, COUNT(*) AS n FROM e GROUP BY status",
}


def all_oracles() -> dict[str, str]:
    # A query that starts with a comma continues the WITH list with steps of its own.
    built = {name: DELIVERIES_SQL + sql for name, sql in _ON_DELIVERIES.items()}
    return built | {name: EVENTS_SQL + sql for name, sql in _ON_EVENTS.items()}
