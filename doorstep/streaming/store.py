"""The event table: each event stored once, found again by day and key filter instead of by a scan.

``path/event_day=.../load=...`` holds the events, a load per micro-batch. ``path`` + ``_filters`` holds, by day, Bloom filters
of the keys of one or more loads. A micro-batch meets the filters of its own days only. Keys that no filter knows are
new; for the others the loads that may hold them are read, by name, and nothing else of the table.

A load's filters are written before its events. A run that stops in between leaves a filter that knows too much, which costs
a read and nothing else, so a replayed micro-batch adds only what is missing. After ``MERGE_GROUPS`` loads a day's filters are
made into one; the old ones go only when the new one is whole.

A filter is cut into slots of one bitmap each; a key sets ``HASHES`` bits of its slot. With ``KEY_BITS`` bits a key, about
one new key in a hundred is taken for a known one.
"""

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EVENT_KEY = ("delivery_id", "status", "timestamp")
EVENT_DAY = "event_day"
LOAD = "load"

#: Bits of Spark's bitmap aggregates; a slot is one bitmap.
SLOT_BITS = 32_768
KEY_BITS = 10
HASHES = 4
MERGE_GROUPS = 16
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

FILTERS = "loads array<string>, slots long, slot long, bits binary, event_day date, group string"


def _path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def has_files(spark: SparkSession, path: str) -> bool:
    folder, files = _path(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such path."""
    folder, files = _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _path(spark, path)
    files.delete(folder, True)


def size(spark: SparkSession, path: str) -> int:
    folder, files = _path(spark, path)
    return files.getContentSummary(folder).getLength()


def day_folder(day) -> str:
    return f"{EVENT_DAY}={NULL_PARTITION if day is None else day}"


def _slots(keys: int) -> int:
    return max(1, -(-keys * KEY_BITS // SLOT_BITS))


def _bit(number: int) -> Column:
    return F.pmod(F.xxhash64("hash", F.lit(number)), F.lit(SLOT_BITS))


def _word(bits: Column, number: Column) -> Column:
    """32 bits of a bitmap as a number."""
    return F.conv(F.hex(F.substring(bits, (number * 4 + 1).cast("int"), F.lit(4))), 16, 10).cast("long")


def _holds(word: Column, position: Column) -> Column:
    # The first byte of a word is its highest; a byte's first bit is its lowest.
    within = (position % 32).cast("int")
    shift = F.lit(24) - F.shiftright(within, 3) * 8 + within % 8
    return F.call_function("shiftright", word, shift) % 2 == 1


def _knows(bits: Column, position: Column) -> Column:
    return _holds(_word(bits, F.shiftright(position, 5)), position)


def hashed(events: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return events.withColumn("hash", F.xxhash64(*keys))


def key_filters(events: DataFrame, sizes: list[tuple]) -> DataFrame:
    """A row per day and slot from events with ``hash``; ``sizes`` has (day, number of keys)."""
    spark = events.sparkSession
    slots = spark.createDataFrame([(d, _slots(n)) for d, n in sizes], "of date, slots long")
    placed = events.join(F.broadcast(slots), F.col(EVENT_DAY).eqNullSafe(F.col("of")))
    # Keys travel, not a bitmap for every task and slot.
    placed = placed.select(EVENT_DAY, "slots", F.pmod("hash", "slots").alias("slot"), "hash")
    placed = placed.repartition(EVENT_DAY, "slots", "slot")
    bits = placed.select(
        EVENT_DAY, "slots", "slot", F.explode(F.array(*[_bit(i) for i in range(HASHES)])).alias("bit")
    )
    return bits.groupBy(EVENT_DAY, "slots", "slot").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _write_filters(filters: DataFrame, path: str, group: str, loads: list[str]) -> None:
    rows = filters.select(
        F.array(*[F.lit(x) for x in loads]).alias("loads"), "slots", "slot", "bits", EVENT_DAY, F.lit(group).alias("group")
    )
    rows.write.mode("append").partitionBy(EVENT_DAY, "group").parquet(f"{path}_filters")


def read_filters(spark: SparkSession, path: str, days: list) -> DataFrame | None:
    """The filters of ``days``; no other day's folder is listed."""
    places = [f"{path}_filters/{day_folder(d)}" for d in days]
    places = [p for p in places if has_files(spark, p)]
    if not places:
        return None
    return spark.read.schema(FILTERS).option("basePath", f"{path}_filters").parquet(*places)


def suspected_loads(events: DataFrame, filters: DataFrame) -> DataFrame:
    """(event_day, load) of the loads that may hold one of the events (with ``hash``)."""
    # The bitmaps become arrays of words before the join: no event copies one or cuts it up.
    words = F.transform(F.sequence(F.lit(0), F.lit(SLOT_BITS // 32 - 1)), lambda k: _word(F.col("bits"), k))
    filters = filters.select(F.col(EVENT_DAY).alias("of"), "slots", "slot", "loads", words.alias("words"))
    looked_up = [_holds(F.get("words", F.shiftright(_bit(i), 5).cast("int")), _bit(i)) for i in range(HASHES)]
    known = reduce(lambda a, b: a & b, looked_up)
    met = events.select(EVENT_DAY, "hash").join(
        filters, F.col(EVENT_DAY).eqNullSafe(F.col("of")) & (F.pmod("hash", "slots") == F.col("slot"))
    )
    return met.where(known).select(EVENT_DAY, F.explode("loads").alias(LOAD)).distinct()


def stored_keys(spark: SparkSession, path: str, schema, loads: list[tuple], keys: tuple[str, ...]) -> DataFrame:
    """Day and keys of the events in ``loads`` (day, load), from their folders alone."""
    places = [f"{path}/{day_folder(d)}/{LOAD}={x}" for d, x in loads]
    # A filter may be ahead of its load.
    places = [p for p in places if has_files(spark, p)]
    days = sorted({d for d, _ in loads if d is not None})
    on_days = F.col(EVENT_DAY).isin(days) if days else F.lit(False)
    if any(d is None for d, _ in loads):
        on_days = on_days | F.col(EVENT_DAY).isNull()
    if not places:
        return spark.createDataFrame([], schema).select(EVENT_DAY, *keys)
    stored = spark.read.schema(schema).option("basePath", path).parquet(*places)
    return stored.where(on_days & F.col(LOAD).isin(sorted({x for _, x in loads}))).select(EVENT_DAY, *keys)


def _by_day(events: DataFrame) -> list[tuple]:
    return [(r[EVENT_DAY], r["n"]) for r in events.groupBy(EVENT_DAY).agg(F.count("*").alias("n")).collect()]


def store_new_events(batch: DataFrame, path: str, keys: tuple[str, ...] = EVENT_KEY) -> list:
    """Append the events of ``batch`` that the table at ``path`` does not hold; gives the days it has.

    Nothing is forgotten, so no event is too late. Keys are compared null-safe: an event without a timestamp has a day of
    its own, and is stored once like any other. Only the days of the batch and the loads that may hold its keys
    go through the driver, as names.
    """
    spark = batch.sparkSession
    fresh = hashed(batch.dropDuplicates(list(keys)).withColumn(EVENT_DAY, F.to_date("timestamp")), keys)
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    new = fresh
    try:
        sizes = _by_day(fresh)
        if not sizes:
            return []
        added = sizes
        filters = read_filters(spark, path, [d for d, _ in sizes])
        if filters is not None:
            loads = [tuple(r) for r in suspected_loads(fresh, filters).collect()]
            if loads:
                schema = fresh.drop("hash").withColumn(LOAD, F.lit("")).schema
                stored = stored_keys(spark, path, schema, loads, keys)
                same = [fresh[c].eqNullSafe(stored[c]) for c in (EVENT_DAY, *keys)]
                new = fresh.join(stored, same, "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
                added = _by_day(new)
        if added:
            load = f"l{uuid.uuid4().hex}"
            _write_filters(key_filters(new, added), path, load, [load])
            # Rebalancing gives a day few files, however many tasks hold events of it.
            rows = new.drop("hash").withColumn(LOAD, F.lit(load)).hint("rebalance", EVENT_DAY)
            rows.write.mode("append").partitionBy(EVENT_DAY, LOAD).parquet(path)
    finally:
        new.unpersist()
        fresh.unpersist()
    for day, _ in sizes:
        merge_filters(spark, path, day, batch.schema, keys)
    return [day for day, _ in sizes]


def merge_filters(spark: SparkSession, path: str, day, schema, keys: tuple[str, ...], most: int = MERGE_GROUPS) -> None:
    """One filter in place of a day's ``most`` or more, built from the keys of their loads."""
    place = f"{path}_filters/{day_folder(day)}"
    groups = folders(spark, place)
    if len(groups) < most:
        return
    filters = read_filters(spark, path, [day])
    # Merged filters of many loads stay until as many new ones have come: each key is read again a few times only.
    sizes = filters.groupBy("group").agg(F.first("loads").alias("loads"), F.first("slots").alias("slots")).collect()
    largest = max(r["slots"] for r in sizes)
    chosen = sizes if sum(r["slots"] for r in sizes) >= 2 * largest else [r for r in sizes if r["slots"] < largest]
    loads = sorted({x for r in chosen for x in r["loads"]})
    whole = T.StructType([*schema.fields]).add(EVENT_DAY, "date").add(LOAD, "string")
    stored = hashed(stored_keys(spark, path, whole, [(day, x) for x in loads], keys), keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        group = f"l{uuid.uuid4().hex}"
        _write_filters(key_filters(stored, [(day, stored.count())]), path, group, loads)
    finally:
        stored.unpersist()
    for row in chosen:
        remove(spark, f"{place}/group={row['group']}")
