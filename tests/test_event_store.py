"""The event table's key filters: what is read, what is never missed, and what a stopped run leaves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from doorstep.streaming import store
from doorstep.streaming.consume import OUTCOMES, live_rate, record_outcomes

SCHEMA = "delivery_id string, status string, timestamp timestamp, city string"


def events(spark, ids, day, status="DELIVERED"):
    time = None if day is None else dt.datetime(2024, 1, day, 10)
    return spark.createDataFrame([(f"d{i}", status, time, "Pune") for i in ids], SCHEMA)


def stored(spark, path):
    return spark.read.parquet(path)


def test_filters_know_every_key_and_few_others(spark):
    day = dt.date(2024, 1, 1)
    keyed = spark.range(20_000).select(F.lit(day).alias("event_day"), F.xxhash64("id").alias("hash"))
    filters = store.key_filters(keyed, [(day, 20_000)]).withColumn("loads", F.array(F.lit("l1")))
    assert filters.count() == store._slots(20_000) > 1
    single = filters.select("event_day", "slots", "slot", "bits", F.array(F.lit("l1")).alias("loads"))

    def known(df):
        met = df.join(single.withColumnRenamed("event_day", "of"), (F.pmod("hash", "slots") == F.col("slot")))
        bits = [store._knows(F.col("bits"), store._bit(i)) for i in range(store.HASHES)]
        return met.where(bits[0] & bits[1] & bits[2] & bits[3]).count()

    assert known(keyed) == 20_000
    others = spark.range(10**6, 10**6 + 20_000).select(F.xxhash64("id").alias("hash"))
    assert known(others) < 800


def test_only_loads_that_may_hold_a_key_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for day in (1, 2, 3):
        for part in range(3):
            store.store_new_events(events(spark, range(100 * part, 100 * part + 100), day), path)
    assert stored(spark, path).count() == 900
    reads = []
    original = store.stored_keys

    def watched(*args):
        found = original(*args)
        reads.append(found)
        return found

    monkeypatch.setattr(store, "stored_keys", watched)
    # New keys of a stored day, then keys of one load.
    store.store_new_events(events(spark, range(5000, 5003), 2), path)
    assert len(reads) <= 1 and all(len(r.inputFiles()) <= 4 for r in reads)
    reads.clear()
    store.store_new_events(events(spark, [110, 111], 2), path)
    (read,) = reads
    files = read.inputFiles()
    assert files and all("event_day=2024-01-02" in f for f in files)
    assert len({f.split("load=")[1].split("/")[0] for f in files}) < 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "city" not in plan.split("ReadSchema")[1]
    # A day that the batch does not have is not even listed.
    reads.clear()
    store.store_new_events(events(spark, range(100), 9), path)
    assert not reads and stored(spark, path).count() == 1003


def test_nulls_repeats_and_late_events(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        batch = events(spark, [1, 1, 2], None).union(events(spark, [1, 2, 2], 3)).union(events(spark, [7], 3, None))
        store.store_new_events(batch, path)
    assert stored(spark, path).count() == 5
    store.store_new_events(events(spark, [], 1), path)
    assert stored(spark, path).count() == 5


def test_a_run_that_stops_before_its_events_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    store.store_new_events(events(spark, range(10), 1), path)
    ahead = store.hashed(events(spark, range(5, 15), 1).withColumn("event_day", F.to_date("timestamp")), store.EVENT_KEY)
    store._write_filters(store.key_filters(ahead, [(dt.date(2024, 1, 1), 10)]), path, "lgone", ["lgone"])
    for _ in range(2):
        store.store_new_events(events(spark, range(5, 15), 1), path)
    assert stored(spark, path).count() == 15


@pytest.mark.parametrize("day", [1, None])
def test_filters_of_a_day_are_merged(spark, tmp_path, monkeypatch, day):
    monkeypatch.setattr(store.merge_filters, "__defaults__", (4,))
    path = str(tmp_path / "t")
    for k in range(9):
        store.store_new_events(events(spark, range(10 * k, 10 * k + 12), day), path)
        name = store.day_folder(None if day is None else dt.date(2024, 1, day))
        assert len(store.folders(spark, f"{path}_filters/{name}")) <= 4
    assert stored(spark, path).count() == 92
    store.store_new_events(events(spark, range(92), day), path)
    assert stored(spark, path).count() == 92


def test_counts_of_many_micro_batches_stay_few(spark, tmp_path):
    out = str(tmp_path)
    for n in range(40):
        counts = spark.createDataFrame([(10, 4, n % 3)], OUTCOMES)
        record_outcomes(counts, out, n, most=6)
        if n % 7 == 0:
            record_outcomes(counts, out, n, most=6)  # a replay
        assert len(store.folders(spark, f"{out}/outcomes")) <= 8
    delivered = sum(n % 3 for n in range(40))
    assert tuple(live_rate(spark, out).first()) == (round(100 * delivered / 160, 1), 160, 400)


def test_a_sum_that_was_not_finished_does_not_count(spark, tmp_path):
    out = str(tmp_path)
    for n in range(3):
        record_outcomes(spark.createDataFrame([(1, 1, 1)], OUTCOMES), out, n)
    (tmp_path / "outcomes" / "upto=1").mkdir()
    assert tuple(live_rate(spark, out).first()) == (100.0, 3, 3)
    # Finished, but what it covers is still there.
    spark.createDataFrame([(2, 2, 0)], OUTCOMES).write.mode("overwrite").parquet(f"{out}/outcomes/upto=1")
    assert tuple(live_rate(spark, out).first()) == (33.3, 3, 3)


def test_a_day_gets_few_files_and_a_repeated_batch_none(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = events(spark, range(400), 1).union(events(spark, range(400), 2)).repartition(40)
    store.store_new_events(batch, path)
    assert stored(spark, path).count() == 800 and len(stored(spark, path).inputFiles()) == 2
    filters = spark.read.parquet(f"{path}_filters").inputFiles()
    store.store_new_events(batch, path)
    assert stored(spark, path).count() == 800 and spark.read.parquet(f"{path}_filters").inputFiles() == filters


def test_suspected_loads_are_those_of_every_key_known(spark):
    days = [dt.date(2024, 1, 1), None]
    keyed = spark.range(2_000).select(F.element_at(F.array(*map(F.lit, days)), (F.col("id") % 2 + 1).cast("int")).alias("event_day"), F.xxhash64("id").alias("hash"))
    filters = store.key_filters(keyed, [(days[0], 1_000), (None, 1_000)]).withColumn("loads", F.array(F.lit("l1"), F.lit("l2")))
    for i in (0, 1, 2, 77, 1_999):
        found = store.suspected_loads(keyed.where(F.col("hash") == F.xxhash64(F.lit(i).cast("long"))), filters)
        assert sorted(map(tuple, found.collect())) == [(days[i % 2], "l1"), (days[i % 2], "l2")]
