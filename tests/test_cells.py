"""Reports rolled up from cells equal the reports built from the attempts."""

import pytest
from pyspark.sql import functions as F

from doorstep.operators import cells
from doorstep.plans import reports
from doorstep.plans.reports import REPORTS, run_reports
from doorstep.sources.star import deliveries

MEAN = "avg_order_value"


def same(got, direct, name):
    """Rows, order of ordered reports and types; only the mean value may differ, in its last digits."""
    assert got.dtypes == direct.dtypes, name
    rounded = [df.withColumn(MEAN, F.round(MEAN, 6)) if MEAN in df.columns else df for df in (got, direct)]
    a, b = ([repr(r) for r in df.collect()] for df in rounded)
    ordered = "Sort" in direct._jdf.queryExecution().logical().toString()
    assert (a, ordered) == (b, ordered) if ordered else sorted(a) == sorted(b), name


@pytest.fixture(scope="module")
def large(spark, sf_dir):
    return deliveries(spark, sf_dir.replace("sf0.001", "sf0.01"))


@pytest.fixture(scope="module")
def large_cells(large):
    return cells.count_cells(large).cache()


def edge_rows(attempts):
    none = dict.fromkeys(
        "city address_type delivery_window order_value is_successful attempt_number has_delivery_preference "
        "proximity_alert_sent".split()
    )
    return attempts(
        {},
        {},
        {"is_successful": 0, "failure_reason": "NOT_HOME"},
        {"is_successful": 0, "failure_reason": None, "attempt_number": 2},
        {"is_successful": 1, "failure_reason": "NOT_HOME", "order_value": 500.0},
        {"city": "Delhi", "is_successful": None, "order_value": None},
        {"city": None, "address_type": "Apartment", "delivery_window": "Morning (9-12)"},
        {"city": "Delhi", "address_type": None, "is_successful": 0, "order_value": 9e9, "proximity_alert_sent": 1},
        {"address_type": "Office", "has_delivery_preference": 1, "attempt_number": 3},
        none,
        none,
    )


def test_every_report_has_a_roll_up():
    assert list(cells.REPORTS) == list(REPORTS)


@pytest.mark.parametrize("name", list(REPORTS))
def test_equal_to_the_report_of_the_attempts(large, large_cells, name):
    same(cells.REPORTS[name](large_cells), REPORTS[name](large), name)


@pytest.mark.parametrize("name", list(REPORTS))
def test_nulls_and_no_attempts(attempts, name):
    df = edge_rows(attempts)
    options = {"min_attempts": 0} if name in ("worst_combinations", "mart_window_alerts") else {}
    same(cells.REPORTS[name](cells.count_cells(df), **options), REPORTS[name](df, **options), name)
    none = df.limit(0)
    same(cells.REPORTS[name](cells.count_cells(none)), REPORTS[name](none), name)


def test_cells_of_loads_add_up(attempts):
    df = edge_rows(attempts)
    numbered = df.withColumn("load", F.pmod(F.xxhash64("delivery_id"), F.lit(3)))
    loads = [cells.count_cells(numbered.where(F.col("load") == k).drop("load")) for k in range(3)]
    rows = lambda d: sorted(map(repr, d.collect()))
    assert rows(cells.merge_cells(*loads)) == rows(cells.count_cells(df))


def test_levels_tell_null_keys_from_rolled_up_ones(attempts):
    counted = cells.count_cells(attempts({"city": None}, {"city": "Pune"}, {"city": "Pune", "is_successful": 0}))
    got = {(r.level, r.city): (r.total_attempts, r.fadr_percent) for r in cells.rates_at_levels(counted, ("city",), ()).collect()}
    assert got == {(0, None): (1, 100.0), (0, "Pune"): (2, 50.0), (1, None): (3, 66.67)}


def test_the_job_reads_the_attempts_once_for_all_reports(spark, sf_dir, tmp_path, monkeypatch):
    counted, sources, real = [], {}, reports.export_mart
    count = cells.count_cells
    monkeypatch.setattr(cells, "count_cells", lambda df: counted.append(df) or count(df))

    def exported(df, path):
        sources[path.rsplit("/", 1)[1]] = df.inputFiles()
        return real(df, path)

    monkeypatch.setattr(reports, "export_mart", exported)
    run_reports(spark, deliveries(spark, sf_dir), str(tmp_path))
    assert len(counted) == 1 and set(sources) == set(REPORTS)
    for name, files in sources.items():
        assert files and all("/cells/" in f for f in files), name
