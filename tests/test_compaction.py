"""Merging the small loads of the event table: what stays, what is read, and what a stopped merge leaves."""

import datetime as dt

import pytest

from doorstep.streaming import compaction, events as stream, store
from test_event_store import SCHEMA, events

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(compaction.compact_day, "__defaults__", (4,))


def table(spark, path):
    from pyspark.sql.types import _parse_datatype_string

    return stream.read_events_table(spark, path, _parse_datatype_string(SCHEMA))


def ids(spark, path):
    return sorted(int(r.delivery_id[1:]) for r in table(spark, path).collect())


def loads(spark, path, day=DAY):
    return store.folders(spark, f"{path}/{store.day_folder(day)}")


def test_which_loads_are_merged():
    assert compaction.smallest({}) == [] and compaction.smallest({"a": 5}) == []
    assert compaction.smallest({"b": 5, "a": 5}) == ["a", "b"]
    # A load that outweighs all smaller ones is left alone, and so are few loads of steep sizes.
    assert compaction.smallest({"a": 5, "b": 5, "large": 100}) == ["a", "b"]
    assert compaction.smallest({"a": 1, "b": 2, "c": 4, "d": 8}) == []
    # Equal loads merged whenever there are eight: an event is rewritten a logarithmic number of times.
    sizes, rewritten = {}, 0
    for n in range(4000):
        sizes[f"l{n}"] = 1
        if len(sizes) >= 8:
            taken = compaction.smallest(sizes)
            if len(taken) > 1:
                total = sum(sizes.pop(x) for x in taken)
                sizes[f"m{n}"], rewritten = total, rewritten + total
        assert len(sizes) <= 16
    assert rewritten <= 4000 * 12


@pytest.mark.parametrize("day", [1, None])
def test_many_micro_batches_leave_few_loads_and_each_event_once(spark, tmp_path, few, day):
    path = str(tmp_path / "t")
    for k in range(12):
        # The last two of each batch come again in the next one.
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 12), day), path)
        assert len(loads(spark, path, DAY if day else None)) <= 6
    assert ids(spark, path) == list(range(122))
    # Late copies of all, found in merged loads by the filters.
    stream.store_and_compact(events(spark, range(122), day), path)
    assert ids(spark, path) == list(range(122))
    assert not store.folders(spark, f"{path}_merges/{store.day_folder(DAY if day else None)}")


def test_filters_of_what_was_replaced_go(spark, tmp_path, few):
    path = str(tmp_path / "t")
    for k in range(4):
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 10), 1), path)
    (merged,) = loads(spark, path)
    groups = store.folders(spark, f"{path}_filters/{store.day_folder(DAY)}")
    assert groups == [f"group={merged.partition('=')[2]}"]
    assert len(table(spark, path).inputFiles()) == 1


def test_other_days_are_left_alone(spark, tmp_path, few):
    path = str(tmp_path / "t")
    for k in range(3):
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 10), 2), path)
    for k in range(4):
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 10), 1), path)
    assert len(loads(spark, path)) == 1 and len(loads(spark, path, dt.date(2024, 1, 2))) == 3


@pytest.mark.parametrize("step", ["filters", "events", "first removal", "later removal", "filter removal"])
def test_a_merge_that_stops_loses_and_doubles_nothing(spark, tmp_path, few, monkeypatch, step):
    path = str(tmp_path / "t")
    for k in range(3):
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 10), 1), path)
    removals = {"n": 0}
    remove, write_filters = store.remove, store._write_filters

    def stop(*args):
        raise KeyboardInterrupt(step)

    def removed(session, place):
        removals["n"] += 1
        at = {"first removal": 1, "later removal": 3, "filter removal": 5}[step]
        return stop() if removals["n"] == at else remove(session, place)

    def filters_of_merged(filters, place, group, names):
        return stop() if group.startswith("m") else write_filters(filters, place, group, names)

    if step == "filters":
        monkeypatch.setattr(store, "_write_filters", filters_of_merged)
    elif step == "events":
        # The merged load is there, but not whole.
        settle = compaction.settle

        def half(session, place, day):
            for load in loads(session, place):
                if load.startswith("load=m"):
                    (tmp_path / "t" / store.day_folder(day) / load / "_SUCCESS").unlink()
                    stop()
            return settle(session, place, day)

        monkeypatch.setattr(compaction, "settle", half)
    else:
        monkeypatch.setattr(store, "remove", removed)
    with pytest.raises(KeyboardInterrupt):
        stream.store_and_compact(events(spark, range(30, 40), 1), path)
    assert ids(spark, path) == list(range(40))
    monkeypatch.undo()
    # The micro-batch is replayed, and the next ones clear up.
    monkeypatch.setattr(compaction.compact_day, "__defaults__", (2,))
    stream.store_and_compact(events(spark, range(30, 40), 1), path)
    assert ids(spark, path) == list(range(40))
    for k in (4, 5):
        stream.store_and_compact(events(spark, range(10 * k, 10 * k + 10), 1), path)
    assert ids(spark, path) == list(range(60))
    assert not compaction.replaced_loads(spark, path)


def test_several_days_in_one_batch_are_merged_together(spark, tmp_path, few, monkeypatch):
    monkeypatch.setattr(store.merge_filters, "__defaults__", (3,))
    path = str(tmp_path / "t")
    for k in range(5):
        batch = events(spark, range(10 * k, 10 * k + 10), 1).union(events(spark, range(10 * k, 10 * k + 10), 2))
        stream.store_and_compact(batch, path)
    assert ids(spark, path) == sorted([*range(50)] * 2)
