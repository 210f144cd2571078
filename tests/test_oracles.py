"""Every registered query with a SQL twin gives the twin's rows."""

import pytest

import __spark_entry__ as contract
from compare import mismatch
from doorstep.plans.oracles import all_oracles
from doorstep.plans.registry import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()
FOREST_QUERIES = {
    "rf_predictions",
    "rf_evaluation",
    "rf_class_report",
    "rf_feature_importance",
    "what_if_uplift",
    "model_roundtrip",
}
# Their thresholds leave no group on the smallest tables.
LARGER = {"worst_combinations", "mart_window_alerts", "daily_window_mart"}


def test_only_the_forest_has_no_twin():
    assert set(QUERIES) - set(ORACLES) == FOREST_QUERIES
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    folder = sf_dir.replace("sf0.001", "sf0.01") if name in LARGER else sf_dir
    assert mismatch(QUERIES[name](spark, folder), ORACLES[name], folder) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["address_type", "delivery_window", "attempts", "fadr_pct"]
    assert result.count() == 20  # five address types, four windows
