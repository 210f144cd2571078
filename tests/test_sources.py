import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from doorstep.operators.marts import fadr_by_segment
from doorstep.schema import DELIVERIES, DELIVERY_COLUMNS
from doorstep.session import scratch_dir
from doorstep.sources import files, landing, star, tables


@pytest.fixture(scope="module")
def df(spark, sf_dir):
    return star.deliveries(spark, sf_dir).cache()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_star_gives_the_declared_columns(df):
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in DELIVERIES]
    assert df.select("delivery_id").distinct().count() == df.count() == 1500


def test_csv_declared_and_inferred(spark, df, tmp_path):
    files.write_deliveries_csv(df, str(tmp_path / "csv"))
    declared = files.read_deliveries(spark, str(tmp_path / "csv"))
    assert same_rows(declared, df)
    inferred = files.read_deliveries(spark, str(tmp_path / "csv"), infer=True)
    assert inferred.columns == DELIVERY_COLUMNS
    assert dict(inferred.dtypes)["delivery_id"] == "int"
    assert dict(inferred.dtypes)["attempt_date"] == "date"


def test_csv_records_that_do_not_fit_are_set_apart(spark, tmp_path):
    good = "a,c,Pune,House,Evening (15-19),10.5,1,,1,2024-01-15,15,0,0"
    bad = [
        good.replace("10.5", "ten").replace("a,", "b,", 1),
        good.replace("2024-01-15", "2024-13-40").replace("a,", "d,", 1),
        good.replace("Pune", "").replace("a,", "e,", 1),
        "f,c,Pune",
    ]
    (tmp_path / "in.csv").write_text("\n".join([",".join(DELIVERY_COLUMNS), good, *bad]))
    kept, broken = files.read_deliveries_checked(spark, str(tmp_path / "in.csv"))
    assert kept.dtypes == [(f.name, f.dataType.simpleString()) for f in DELIVERIES]
    assert [r.city for r in kept.select("city").collect()] == ["Pune"]
    assert {r.delivery_id for r in broken.select("delivery_id").collect()} == set("bdef")
    assert {r.order_value for r in broken.collect()} == {"ten", "10.5", None}


def test_json_array_and_lines(spark, tmp_path):
    records = [{"userId": 1, "id": i, "title": "t", "body": "b"} for i in range(3)]
    records.append({"userId": 2, "id": 9, "extra": True})
    schema = "userId int, id int, title string, body string"
    (tmp_path / "array.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    array = files.load_json_records(spark, str(tmp_path / "array.json"), schema, multi_line=True)
    lines = files.load_json_records(spark, str(tmp_path / "lines.json"), schema)
    assert array.count() == 4 and same_rows(array, lines)
    assert array.where("userId = 2").first().title is None


def test_partitioned_write_and_read(spark, df, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        assert files.write_partitioned(df, path) == 1500
    back = files.read_partitioned(spark, path, DELIVERIES, expected_rows=1500)
    assert back.columns[-1] == "city"
    assert same_rows(back.select(DELIVERY_COLUMNS), df)
    cities = {p.name for p in Path(path).glob("city=*")}
    assert len(cities) == df.select("city").distinct().count()
    with pytest.raises(ValueError):
        files.read_partitioned(spark, path, DELIVERIES, expected_rows=1)


def test_partition_and_column_pruning(spark, df, tmp_path):
    path = str(tmp_path / "out")
    files.write_partitioned(df, path)
    one = files.read_partitioned(spark, path, DELIVERIES).where("city = 'ASIA'").select("is_successful")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan
    assert "ReadSchema: struct<is_successful:int>" in plan


def test_table_is_replaced_not_appended(spark, df, tmp_path):
    for _ in range(2):
        tables.load_table(df, "reloaded")
    assert tables.scan(spark, "reloaded").count() == 1500
    tables.load_table(df.limit(10), "reloaded_at", path=str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_cached_scan(spark, df):
    tables.load_table(df, "cached_table")
    cached = tables.scan(spark, "cached_table", "city", "is_successful", cached=True)
    assert cached.columns == ["city", "is_successful"] and cached.is_cached
    assert cached.count() == 1500
    assert "InMemoryTableScan" in cached.groupBy("city").count()._jdf.queryExecution().toString()
    cached.unpersist()


def test_view_and_ad_hoc_sql(spark, df):
    tables.as_view(df, "deliveries")
    top = spark.sql(
        "SELECT city, SUM(1 - is_successful) AS failed FROM deliveries GROUP BY city"
        " HAVING failed > 0 ORDER BY failed DESC, city LIMIT 1"
    ).first()
    failed = df.where("is_successful = 0").groupBy("city").count()
    assert top.failed == failed.agg(F.max("count")).first()[0]


def test_load_report(df):
    report = tables.load_report(df).collect()
    assert [(r.column_name, r.data_type) for r in report] == df.dtypes
    assert {r.rows for r in report} == {1500}


def test_export_is_plain_csv(df, tmp_path):
    mart = fadr_by_segment(df)
    files.export_mart(mart, str(tmp_path / "mart"))
    lines = [
        line for part in Path(tmp_path / "mart").glob("*.csv") for line in part.read_text().splitlines()
    ]
    header = "city,address_type,total_attempts,successful,fadr"
    assert lines.count(header) >= 1
    assert len([line for line in lines if line != header]) == mart.count()


def test_tables_are_landed_once_and_again_when_cleared(spark, sf_dir, df, tmp_path):
    first = landing.deliveries_path(spark, sf_dir)
    assert landing.deliveries_path(spark, sf_dir) == first
    assert same_rows(landing.deliveries(spark, sf_dir), df)
    writes = []
    for _ in range(2):
        # Nothing is written to the folder, as if it had been cleared.
        landing._once(spark, str(tmp_path), "none", writes.append)
    assert len(set(writes)) == 2


def test_scratch_is_fresh_and_shared(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_numeric_looking_partition_keeps_its_type(spark, attempts, tmp_path):
    files.write_partitioned(attempts({"city": "01"}), str(tmp_path / "p"))
    assert files.read_partitioned(spark, str(tmp_path / "p"), DELIVERIES).first().city == "01"


def test_columns_are_bound_by_the_header(spark, attempts, tmp_path):
    df = attempts({"city": "Delhi", "address_type": "Office"})
    files.write_deliveries_csv(df.select(*df.columns[::-1], F.lit("x").alias("extra")), str(tmp_path / "in"))
    back = files.read_deliveries(spark, str(tmp_path / "in"))
    assert back.columns == df.columns and (back.first().city, back.first().address_type) == ("Delhi", "Office")
    files.write_deliveries_csv(df.drop("city"), str(tmp_path / "short"))
    with pytest.raises(ValueError, match="no column city"):
        files.read_deliveries(spark, str(tmp_path / "short"))
