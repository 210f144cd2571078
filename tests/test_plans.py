"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from doorstep.operators import counts, rates
from doorstep.plans.registry import all_queries
from doorstep.sources import landing
from doorstep.sources.star import deliveries

# These run jobs while they are built, so their result is a plain scan or a stream's sink.
EAGER = re.compile("roundtrip|record|reload|export_mart|daily|event_|live|csv|cached|scan|load_report|rf_|what_if|label_encode|feature|partitions")
LAZY = sorted(n for n in all_queries() if not EAGER.search(n))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_global_window(spark, sf_dir, name):
    plan = physical(all_queries()[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow"):
        assert node not in plan
    windows = re.findall(r"windowspecdefinition\(([^,]+),", plan)
    if name == "classification_metrics":
        # One window inside each score range, one over the range totals.
        assert all(w.startswith("part#") for w in windows)
    elif name == "json_array":
        # Inside each block of a file, and over a file's blocks.
        assert {w.split("#")[0] for w in windows} == {"file"}
    elif name == "worst_address_per_city":
        assert {w.split("#")[0] for w in windows} == {"city"}
    else:
        assert not windows


def test_scans_read_only_what_a_report_needs(spark, sf_dir):
    plan = physical(rates.fadr_by_address(deliveries(spark, sf_dir)))
    orders = re.search(r"orders\.parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S).group(1)
    assert {c.split(":")[0] for c in orders.split(",")} == {
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
    }
    cities = physical(counts.list_cities(deliveries(spark, sf_dir)))
    orders = re.search(r"orders\.parquet.*?ReadSchema: struct<([^>]*)>", cities, re.S).group(1)
    assert orders == "o_custkey:bigint"


def test_city_filter_reaches_the_dimension_scan(spark, sf_dir):
    plan = physical(rates.city_summary(deliveries(spark, sf_dir), city="ASIA"))
    assert "EqualTo(r_name,ASIA)" in plan


@pytest.mark.parametrize(
    "operator", [counts.failure_reasons, counts.repeat_attempts, rates.rate_vs_overall]
)
def test_shares_scan_the_attempts_once(spark, sf_dir, operator):
    """The whole behind each share reuses the grouped rows' exchange."""
    attempts = landing.deliveries(spark, sf_dir)
    df = operator(attempts)
    df.collect()
    # The landed table brings no exchange but that of its grouped rows.
    assert "ReusedExchange" in physical(df)


def test_aggregation_is_partial_before_the_shuffle(spark, sf_dir):
    plan = physical(rates.fadr_by_window(deliveries(spark, sf_dir)))
    assert plan.index("functions=[count(1)") < plan.index("Exchange hash") < plan.index("partial_count(1)")


def test_top_k_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(rates.worst_combinations(deliveries(spark, sf_dir)))


def test_a_hot_customer_is_split(spark, sf_dir, tmp_path):
    """With both join sides too large to broadcast, AQE splits a customer with a third of all orders."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
    many = orders.withColumn("o_custkey", hot.cast("long")).repartition(8)
    many.write.parquet(f"{tmp_path}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "8192",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "8192",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    other = spark.newSession()
    for key, value in settings.items():
        other.conf.set(key, value)
    df = rates.city_summary(deliveries(other, str(tmp_path)))
    total = sum(r.attempts for r in df.collect())
    plan = physical(df)
    assert total == 15000
    assert "SortMergeJoin(skew=true)" in plan
    assert plan.split("== Initial Plan ==")[0].count("BroadcastHashJoin") == 2
