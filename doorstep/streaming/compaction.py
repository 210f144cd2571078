"""Small loads of the event table made into large ones, so that a consumer can run for months.

A day's loads are merged once they are many. Of them, in order of size, those are taken that are no larger than all smaller
ones together: a merged load at least doubles what it takes in, so an event is rewritten a logarithmic number of
times, and the loads left alone are few, since each outweighs all smaller ones.

``path`` + ``_merges`` holds what a merge replaces; it is written first, then the key filters of the merged load, then its
events. From the moment the merged load is whole it counts and what it replaces does not; before, it is the other
way round. :func:`replaced_loads` tells which, so a run that stops anywhere neither loses nor doubles an event for
:func:`doorstep.streaming.events.read_events_table`. The next merge of the day clears up. A scan that was
planned before a merge and still runs after it may find its files gone, and has to be repeated.
"""

import uuid

from pyspark.sql import SparkSession, functions as F, types as T

from doorstep.streaming import store
from doorstep.streaming.store import EVENT_DAY, LOAD

#: Loads of a day that are kept before they are merged.
MOST_LOADS = 32


def compact_day(
    spark: SparkSession, path: str, day, schema, keys: tuple[str, ...], most: int = MOST_LOADS
) -> None:
    """Merge the small loads of a day once it has ``most``; ``schema`` is that of the events."""
    folder = store.day_folder(day)
    if len(store.folders(spark, f"{path}/{folder}")) < most:
        return
    settle(spark, path, day)
    chosen = smallest({x: store.size(spark, f"{path}/{folder}/{x}") for x in store.folders(spark, f"{path}/{folder}")})
    if len(chosen) < 2:
        return
    merged = f"m{uuid.uuid4().hex}"
    covered = [x.partition("=")[2] for x in chosen]
    names = spark.createDataFrame([(x,) for x in covered], f"{LOAD} string").coalesce(1)
    names.write.parquet(f"{path}_merges/{folder}/{LOAD}={merged}")
    whole = T.StructType([*schema.fields]).add(EVENT_DAY, "date").add(LOAD, "string")
    events = spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{folder}/{x}" for x in chosen])
    keyed = store.hashed(events.select(EVENT_DAY, *keys), keys)
    store._write_filters(store.key_filters(keyed, [(day, events.count())]), path, merged, [merged])
    # Rebalancing gives a few large files, however many small ones there were.
    events.drop(EVENT_DAY, LOAD).hint("rebalance").write.parquet(f"{path}/{folder}/{LOAD}={merged}")
    settle(spark, path, day)


def smallest(sizes: dict[str, int]) -> list[str]:
    """The loads to merge: by size, each no larger than all smaller ones together."""
    order = sorted(sizes, key=lambda x: (sizes[x], x))
    taken, total = 0, 0
    for k, x in enumerate(order):
        if k > 0 and sizes[x] <= total:
            taken = k + 1
        total += sizes[x]
    return order[:taken]


def _merges(spark: SparkSession, path: str, folder: str) -> list[tuple[str, list[str] | None, bool]]:
    """Of the merges of a day: the merged load, what it replaces (None: never begun), and whether it is whole."""
    found = []
    for name in store.folders(spark, f"{path}_merges/{folder}"):
        place = f"{path}_merges/{folder}/{name}"
        covered = None
        if store.has_files(spark, f"{place}/_SUCCESS"):
            covered = [r[LOAD] for r in spark.read.schema(f"{LOAD} string").parquet(place).collect()]
        whole = store.has_files(spark, f"{path}/{folder}/{name}/_SUCCESS")
        found.append((name.partition("=")[2], covered, whole))
    return found


def replaced_loads(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(day folder, load) of all loads that do not count; none but while a merge runs or after one that stopped."""
    out = []
    for folder in store.folders(spark, f"{path}_merges"):
        for merged, covered, whole in _merges(spark, path, folder):
            out += [(folder, x) for x in (covered or [] if whole else [merged])]
    return out


def settle(spark: SparkSession, path: str, day) -> None:
    """Remove what merges of a day have replaced, or what is there of a merge that stopped."""
    folder = store.day_folder(day)
    for merged, covered, whole in _merges(spark, path, folder):
        gone = set(covered or []) if whole else {merged}
        for load in sorted(gone):
            store.remove(spark, f"{path}/{folder}/{LOAD}={load}")
        filters = store.read_filters(spark, path, [day])
        if filters is not None:
            for row in filters.groupBy("group").agg(F.first("loads").alias("loads")).collect():
                if set(row["loads"]) <= gone:
                    store.remove(spark, f"{path}_filters/{folder}/group={row['group']}")
        store.remove(spark, f"{path}_merges/{folder}/{LOAD}={merged}")
    if not store.folders(spark, f"{path}_merges/{folder}"):
        store.remove(spark, f"{path}_merges/{folder}")
