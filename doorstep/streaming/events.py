"""Decode, store and summarise the delivery event stream.

Every transformation works on a batch or a streaming DataFrame. Sources and sinks are chosen by
format, so the same job runs against a message topic or against files of JSON lines.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from doorstep.functions.labels import is_terminal
from doorstep.functions.text import ingest_stamp, json_fields, json_text
from doorstep.schema import EVENT, TOPIC
from doorstep.streaming.compaction import compact_day, replaced_loads
from doorstep.streaming.store import EVENT_KEY, LOAD, has_files, store_new_events

MALFORMED = "malformed"


def event_source(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Unbounded ``(key, value)`` text rows.

    The default subscribes to the event topic from its earliest offset; on a restart the checkpoint
    of the query that reads it decides where to resume. ``fmt="text"`` reads JSON lines.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", TOPIC).option("startingOffsets", "earliest")
    raw = reader.options(**options).load()
    if "key" not in raw.columns:
        return raw.select(F.lit(None).cast("string").alias("key"), "value")
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def decode_events(
    raw: DataFrame, schema: T.StructType = EVENT
) -> tuple[DataFrame, DataFrame]:
    """Typed events, and the raw text of the messages that do not fit ``schema``.

    An absent field is NULL and an unknown one is ignored; neither makes a message malformed.
    """
    return split_events(parse_events(raw, schema), schema)


def parse_events(raw: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """The messages beside what was parsed of them."""
    return raw.select("value", json_fields("value", schema, MALFORMED).alias("event"))


def split_events(
    parsed: DataFrame, schema: T.StructType = EVENT
) -> tuple[DataFrame, DataFrame]:
    """The two outputs of :func:`decode_events` from messages parsed once."""
    fits = F.col(f"event.{MALFORMED}").isNull() & F.col("event").isNotNull()
    good = parsed.where(fits).select(*[f"event.{name}" for name in schema.fieldNames()])
    bad = parsed.where(~fits).select("value")
    return good, bad


def encode_events(events: DataFrame, key: str = "city") -> DataFrame:
    """``(key, value)`` messages with the whole event as JSON.

    Keying by city keeps each city's events in order, at the price of one partition per city; key
    by ``delivery_id`` to keep the order per delivery and spread a busy city.
    """
    return events.select(F.col(key).alias("key"), json_text(*events.columns).alias("value"))


def publish_events(
    encoded: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    *,
    available_now: bool = False,
    every: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Send ``(key, value)`` messages to the event topic, or to another sink."""
    if fmt == "kafka":
        options = {"topic": TOPIC, **options}
    return _start(encoded, fmt, checkpoint, available_now, every, **options)


def stamp_consumed(events: DataFrame) -> DataFrame:
    return events.withColumn("consumed_at", ingest_stamp())


def append_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append every event to the Parquet event table at ``path``, one commit per micro-batch.

    The sink's commit log and the checkpoint make a replayed micro-batch harmless. ``every`` sets
    the time between micro-batches; ``available_now`` stops when the backlog is read.
    """
    return _start(events, "parquet", checkpoint, available_now, every, path=path)


def live_fadr(events: DataFrame) -> DataFrame:
    """Success rate over all terminal events so far, and their number.

    A rescheduled delivery counts as a failure. With no terminal event the rate is NULL. On a
    stream the state is a sum and a count.
    """
    delivered = F.when(F.col("status") == "DELIVERED", 1.0).otherwise(0.0)
    return events.where(is_terminal()).agg(
        F.round(F.avg(delivered) * 100, 1).alias("live_fadr_pct"),
        F.count("*").alias("terminal_events"),
    )


def show_live_fadr(
    rate: DataFrame,
    name: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the one-row answer of :func:`live_fadr` as the in-memory table ``name``.

    ``every`` sets how often it is refreshed.
    """
    return _start(
        rate, "memory", checkpoint, available_now, every, mode="complete", name=name
    )


def append_new_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: tuple[str, ...] = EVENT_KEY,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append each event once, however often and however late it arrives.

    See :func:`store_and_compact`, which every micro-batch goes through.
    """
    writer = events.writeStream.foreachBatch(lambda batch, _: store_and_compact(batch, path, keys))
    return _launch(writer, checkpoint, available_now, every)


def store_and_compact(batch: DataFrame, path: str, keys: tuple[str, ...] = EVENT_KEY) -> None:
    """:func:`doorstep.streaming.store.store_new_events`, then the merge of days with many loads."""
    for day in store_new_events(batch, path, keys):
        compact_day(batch.sparkSession, path, day, batch.schema, keys)


def read_events_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored events; an event table that does not exist yet has none.

    Loads that a merge has replaced, or that a stopped one left, are passed over by their partition.
    """
    if not has_files(spark, path):
        return spark.createDataFrame([], schema)
    replaced = [load for _, load in replaced_loads(spark, path)]
    if not replaced:
        return spark.read.schema(schema).parquet(path).select(schema.fieldNames())
    table = spark.read.schema(T.StructType([*schema.fields]).add(LOAD, "string")).parquet(path)
    return table.where(~F.col(LOAD).isin(replaced)).select(schema.fieldNames())


class Progress(StreamingQueryListener):
    """Micro-batches and rows of every query since the listener was added to ``spark.streams``.

    A query's own list of reports keeps the latest only, and so cannot be summed.
    """

    def __init__(self) -> None:
        self.seen: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.seen.setdefault(str(event.runId), {"batches": 0, "rows": 0})

    def onQueryProgress(self, event) -> None:
        own = self.seen.setdefault(str(event.progress.runId), {"batches": 0, "rows": 0})
        own["batches"] += 1
        own["rows"] += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        """Of a query that has ended, once its last report has come."""
        SparkSession.active().sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return self.seen.get(str(query.runId), {"batches": 0, "rows": 0})


def _start(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    available_now: bool,
    every: str | None,
    *,
    mode: str = "append",
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).outputMode(mode).options(**options)
    if name:
        writer = writer.queryName(name)
    return _launch(writer, checkpoint, available_now, every)


def _launch(
    writer: DataStreamWriter, checkpoint: str, available_now: bool, every: str | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
