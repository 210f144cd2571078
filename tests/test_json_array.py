import json
import random

import pytest
from pyspark.sql import types as T

from doorstep.plans import registry
from doorstep.sources.files import load_json_records
from doorstep.sources.json_array import array_objects, load_json_array

NESTED = T.StructType().add("a", "string").add("b", T.ArrayType(T.StructType().add("c", "string")))
SCHEMA = T.StructType().add("id", "long").add("text", "string").add("inner", NESTED)


def records(n, seed=1):
    rng = random.Random(seed)
    atoms = ["}", "{", '"', "\\", "[", "]", ",", "é", "\n", "a", '\\"', "},{", " "]
    rows = []
    for i in range(n):
        word = lambda: "".join(rng.choices(atoms, k=rng.randint(0, 8)))
        row = {"id": i, "text": word(), "inner": {"a": word(), "b": [{"c": word()} for _ in range(rng.randint(0, 3))]}}
        if i % 7 == 0:
            row = {"id": i}
        rows.append(row)
    return rows


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_by_many_tasks(spark, tmp_path, small_blocks, indent):
    rows = records(150)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(indent)), encoding="utf-8")
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
    assert pieces.rdd.getNumPartitions() >= 4
    got = load_json_array(spark, str(tmp_path / "a.json"), SCHEMA)
    want = load_json_records(spark, str(tmp_path / "a.json"), SCHEMA, multi_line=True)
    key = lambda r: r.id
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert got.count() == 150


def test_several_files_and_empty_arrays(spark, tmp_path):
    for name, text in {"a": json.dumps(records(5)), "b": "[]", "c": " [ ] \n", "d": json.dumps(records(3, 2)) + "\n", "e": ""}.items():
        (tmp_path / f"{name}.json").write_text(text)
    objects = array_objects(spark, str(tmp_path)).collect()
    assert len(objects) == 8
    assert sorted((json.loads(r.value) for r in objects), key=str) == sorted(records(5) + records(3, 2), key=str)
    only = load_json_array(spark, str(tmp_path / "b.json"), SCHEMA)
    assert only.count() == 0 and only.schema == SCHEMA


def test_arrays_of_bounded_size_are_whole_files(spark, tmp_path):
    rows = [(str(i), f"x{{{i}") for i in range(50)] + [(None, "no id")]
    registry._write_arrays(spark.createDataFrame(rows, "delivery_id string, city string"), str(tmp_path / "a"), most=20)
    arrays = [json.loads(p.read_text()) for p in sorted((tmp_path / "a").glob("part-*"))]
    assert len(arrays) == 3 and max(map(len, arrays)) < 40
    got = [(r.get("delivery_id"), r["city"]) for a in arrays for r in a if "city" in r]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_windows_hold_no_text(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(records(30)))
    plan = array_objects(spark, str(tmp_path / "a.json"))._jdf.queryExecution().optimizedPlan()
    below = [plan.p(i) for i in range(200) if plan.p(i) is not None and plan.p(i).nodeName() == "Window"]
    assert below and not any('value' in w.output().mkString(",") for w in below)
