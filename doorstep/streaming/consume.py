"""The consumer job: one read and one parse of the source, three outputs per micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from doorstep.functions.labels import is_terminal
from doorstep.streaming import events as stream, store

#: Bounds of a micro-batch, so that a backlog is worked off in parts; options given override them.
BATCH_BOUNDS = {
    "kafka": {"maxOffsetsPerTrigger": "5000000"},
    "text": {"maxBytesPerTrigger": str(8 * 1024**3)},
}

OUTCOMES = "events long, terminal_events long, delivered long"
#: Counts of single micro-batches that are kept beside the sum of those before.
MOST_COUNTS = 32


def consume_events(
    spark: SparkSession,
    out: str,
    fmt: str = "kafka",
    *,
    every: str | None = None,
    available_now: bool = False,
    report: Callable[[dict], None] | None = None,
    **options: str,
) -> StreamingQuery:
    """Store new events, set malformed messages apart and count outcomes, micro-batch by micro-batch.

    Under ``out``: ``events`` (by day, each event once) with their key filters, ``malformed`` with a folder per
    micro-batch, and ``outcomes``. A replay overwrites its own folders. Any failure ends the query. The live rate of what
    has been received is :func:`live_rate`, at any time and from any session; ``report`` is called with it after
    every micro-batch.
    """
    raw = stream.event_source(spark, fmt, **{**BATCH_BOUNDS.get(fmt, {}), **options})

    def take(batch: DataFrame, number: int) -> None:
        parsed = stream.parse_events(batch).persist()
        try:
            good, bad = stream.split_events(parsed)
            stream.store_and_compact(stream.stamp_consumed(good), f"{out}/events")
            bad.write.mode("overwrite").parquet(f"{out}/malformed/batch={number}")
            record_outcomes(outcomes(good), out, number)
        finally:
            parsed.unpersist()
        if report is not None:
            report({"batch": number, **live_rate(batch.sparkSession, out).first().asDict()})

    writer = raw.writeStream.foreachBatch(take)
    return stream._launch(writer, f"{out}/checkpoint", available_now, every)


def outcomes(events: DataFrame) -> DataFrame:
    """One row: events, terminal events and delivered ones."""
    return events.agg(
        F.count("*").alias("events"),
        F.count_if(is_terminal()).alias("terminal_events"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered"),
    )


def _counted(spark: SparkSession, out: str) -> tuple[list[int], list[int]]:
    """Numbers of the last micro-batches of whole sums, and of the micro-batches counted by themselves."""
    found: dict[str, list[int]] = {"upto": [], "batch": []}
    for folder in store.folders(spark, f"{out}/outcomes"):
        name, _, number = folder.partition("=")
        if name in found and store.has_files(spark, f"{out}/outcomes/{folder}/_SUCCESS"):
            found[name].append(int(number))
    return found["upto"], found["batch"]


def record_outcomes(counts: DataFrame, out: str, number: int, most: int = MOST_COUNTS) -> None:
    """Keep one micro-batch's counts; after ``most`` of them the earlier ones become one sum.

    When a micro-batch runs, all before it are done and never come again, so only they are summed. A sum counts
    once it is whole, and what it covers is passed over from then on, whether or not it is removed yet.
    """
    spark = counts.sparkSession
    upto, batches = _counted(spark, out)
    earlier = [n for n in batches if n < number]
    if len(earlier) >= most:
        last = max(earlier)
        _sums(spark, out, before=number).write.mode("overwrite").parquet(f"{out}/outcomes/upto={last}")
        for name, numbers in (("batch", earlier), ("upto", [n for n in upto if n != last])):
            for n in numbers:
                store.remove(spark, f"{out}/outcomes/{name}={n}")
    counts.write.mode("overwrite").parquet(f"{out}/outcomes/batch={number}")


def _sums(spark: SparkSession, out: str, before: float = float("inf")) -> DataFrame:
    upto, batches = _counted(spark, out)
    last = max(upto, default=-1)
    names = [f"upto={n}" for n in upto if n == last] + [f"batch={n}" for n in batches if last < n < before]
    counts = spark.read.schema(OUTCOMES).parquet(*[f"{out}/outcomes/{n}" for n in names]) if names else spark.createDataFrame([], OUTCOMES)
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns])


def live_rate(spark: SparkSession, out: str) -> DataFrame:
    """Events received so far and the success rate over the terminal ones, from a bounded number of rows."""
    rate = F.round(F.try_divide("delivered", "terminal_events") * 100, 1)
    return _sums(spark, out).select(rate.alias("live_fadr_pct"), "terminal_events", "events")
