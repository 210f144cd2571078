import json

import pytest
from pyspark.sql import functions as F

from doorstep.schema import EVENT, NARROW_EVENT, STATUSES
from doorstep.sources.star import read_events
from doorstep.streaming import events as stream, store
from doorstep.streaming.consume import consume_events, live_rate

EVENT_ROW = {
    "delivery_id": "d1", "city": "Pune", "address_type": "House", "window": "Evening (15-19)",
    "status": "PICKED_UP", "timestamp": "2024-01-15T10:11:12.345678", "order_value": 10.5, "attempt": 1,
}


def write_log(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
    (folder / f"{name}.txt").write_text(text + "\n")


def run(query):
    query.awaitTermination()
    return query


@pytest.fixture
def log(tmp_path):
    return tmp_path / "log"


def statuses(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "status string")


def test_decode_sets_malformed_apart(spark, log):
    missing = {k: v for k, v in EVENT_ROW.items() if k != "attempt"}
    wrong_type = {**EVENT_ROW, "order_value": "a lot"}
    write_log(log, "a", EVENT_ROW, missing, {**EVENT_ROW, "extra": 1}, "{broken", wrong_type, "[]")
    raw = spark.read.text(str(log))
    good, bad = stream.decode_events(raw)
    assert good.schema == EVENT
    assert good.count() == 3 and good.where("attempt IS NULL").count() == 1
    assert good.where("status = 'PICKED_UP'").count() == 3
    assert good.select(F.date_format("timestamp", "HH:mm:ss.SSSSSS")).first()[0] == "10:11:12.345678"
    assert {r.value for r in bad.collect()} == {"{broken", json.dumps(wrong_type), "[]"}


def test_whole_second_timestamps_decode(spark, log):
    write_log(log, "a", {**EVENT_ROW, "timestamp": "2024-01-15T10:11:12"})
    good, _ = stream.decode_events(spark.read.text(str(log)))
    assert str(good.first().timestamp) == "2024-01-15 10:11:12"


def test_narrow_events(spark, log):
    write_log(log, "a", EVENT_ROW, {"delivery_id": "D0007", "city": "Pune"})
    good, bad = stream.decode_events(spark.read.text(str(log)), NARROW_EVENT)
    assert good.schema == NARROW_EVENT and good.count() == 2 and bad.count() == 0
    assert good.where("status IS NULL").first().delivery_id == "D0007"


def test_encode_then_decode(spark, sf_dir):
    sent = read_events(spark, sf_dir)
    encoded = stream.encode_events(sent)
    assert encoded.columns == ["key", "value"]
    assert encoded.where(F.get_json_object("value", "$.city") != F.col("key")).count() == 0
    received, bad = stream.decode_events(encoded)
    assert bad.count() == 0
    assert sent.exceptAll(received).isEmpty() and received.exceptAll(sent).isEmpty()
    assert stream.encode_events(sent, key="delivery_id").first().key == sent.first().delivery_id


def test_live_fadr(spark):
    rate = stream.live_fadr(statuses(spark, *STATUSES, "DELIVERED")).first()
    assert tuple(rate) == (50.0, 4)
    assert tuple(stream.live_fadr(statuses(spark, "FAILED")).first()) == (0.0, 1)
    assert tuple(stream.live_fadr(statuses(spark, "IN_TRANSIT")).first()) == (None, 0)


def test_live_fadr_follows_the_stream(spark, log, tmp_path):
    def answer():
        events, _ = stream.decode_events(stream.event_source(spark, "text", path=str(log)))
        run(
            stream.show_live_fadr(
                stream.live_fadr(events), "live_test", str(tmp_path / "ck"), available_now=True
            )
        )
        return tuple(spark.table("live_test").first())

    write_log(log, "a", {**EVENT_ROW, "status": "DELIVERED"}, EVENT_ROW)
    assert answer() == (100.0, 1)
    write_log(log, "b", {**EVENT_ROW, "status": "RESCHEDULED"})
    assert answer() == (50.0, 2)


def test_append_resumes_without_duplicates(spark, log, tmp_path):
    def drain():
        events, _ = stream.decode_events(stream.event_source(spark, "text", path=str(log)))
        return run(
            stream.append_events(
                stream.stamp_consumed(events), str(tmp_path / "table"), str(tmp_path / "ck"),
                available_now=True,
            )
        )

    write_log(log, "a", EVENT_ROW, {**EVENT_ROW, "delivery_id": "d2"})
    drain()
    write_log(log, "b", {**EVENT_ROW, "delivery_id": "d3"})
    drain(), drain()
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.columns == [*EVENT.fieldNames(), "consumed_at"]
    assert table.count() == 3 and table.where("consumed_at IS NULL").count() == 0


def test_progress_counts_every_micro_batch(spark, log, tmp_path):
    """More micro-batches than a query keeps reports of."""
    for i in range(105):
        write_log(log, f"{i:03d}", {**EVENT_ROW, "delivery_id": f"d{i}"})
    seen = stream.Progress()
    spark.streams.addListener(seen)
    try:
        source = stream.event_source(spark, "text", path=str(log), maxFilesPerTrigger="1")
        query = run(
            stream.append_events(
                stream.decode_events(source)[0], str(tmp_path / "t"), str(tmp_path / "ck"), available_now=True
            )
        )
        assert seen.of(query) == {"batches": 105, "rows": 105}
    finally:
        spark.streams.removeListener(seen)


def test_each_event_is_stored_once_and_none_is_too_late(spark, log, tmp_path):
    def drain():
        events, _ = stream.decode_events(stream.event_source(spark, "text", path=str(log)))
        run(stream.append_new_events(events, str(tmp_path / "t"), str(tmp_path / "ck"), available_now=True))
        return stream.read_events_table(spark, str(tmp_path / "t"), EVENT)

    other = {**EVENT_ROW, "status": "FAILED"}
    timeless = {k: v for k, v in EVENT_ROW.items() if k != "timestamp"}
    assert stream.read_events_table(spark, str(tmp_path / "t"), EVENT).count() == 0
    write_log(log, "a", *[EVENT_ROW] * 500, other, timeless, timeless)
    assert drain().count() == 3
    late = {**EVENT_ROW, "timestamp": "1999-01-01T00:00:00"}
    write_log(log, "b", EVENT_ROW, {**EVENT_ROW, "delivery_id": "d2"}, other, late, late, timeless)
    table = drain()
    assert {(r.delivery_id, r.status, r.timestamp and r.timestamp.year) for r in table.collect()} == {
        ("d1", "PICKED_UP", 2024), ("d1", "FAILED", 2024), ("d2", "PICKED_UP", 2024),
        ("d1", "PICKED_UP", 1999), ("d1", "PICKED_UP", None),
    }
    assert table.count() == 5 and table.columns == EVENT.fieldNames()


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    rows = [{**EVENT_ROW, "delivery_id": f"d{i}"} for i in range(5)]
    batch, _ = stream.decode_events(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    for _ in range(2):
        store.store_new_events(batch, str(tmp_path / "t"))
    store.store_new_events(batch.limit(0), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_consumer_restarts(spark, log, tmp_path):
    def consume():
        consume_events(spark, str(tmp_path / "out"), "text", path=str(log), available_now=True).awaitTermination()
        return tuple(live_rate(spark, str(tmp_path / "out")).first())

    done = {**EVENT_ROW, "status": "DELIVERED"}
    write_log(log, "a", done, done, {**EVENT_ROW, "status": "FAILED"}, "broken")
    assert consume() == (66.7, 3, 3)
    write_log(log, "b", {**done, "delivery_id": "d2"}, EVENT_ROW)
    assert consume() == (75.0, 4, 5) and consume() == (75.0, 4, 5)
    stored = spark.read.parquet(str(tmp_path / "out" / "events"))
    assert stored.count() == 4 and stored.where("consumed_at IS NULL").count() == 0
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out" / "malformed")).collect()] == ["broken"]


def test_publish_to_a_file_sink(spark, sf_dir, tmp_path):
    sent = read_events(spark, sf_dir)
    sent.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "in"))
    query = stream.publish_events(
        stream.encode_events(source).select("value"), str(tmp_path / "ck"), "text",
        every="1 second", path=str(tmp_path / "out"),
    )
    query.processAllAvailable()
    query.stop()
    assert spark.read.text(str(tmp_path / "out")).count() == sent.count()
