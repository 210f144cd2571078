import pytest
from pyspark.sql import functions as F

from doorstep.operators.quality import QualityError
from doorstep.plans.daily_job import DailyOutputs, run_daily
from doorstep.sources.files import write_deliveries_csv
from doorstep.sources.star import deliveries


@pytest.fixture
def landing(spark, sf_dir, tmp_path):
    write_deliveries_csv(deliveries(spark, sf_dir), str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_rerun_replaces_every_output(spark, landing, tmp_path):
    for _ in range(2):
        out = run_daily(spark, landing, str(tmp_path / "out"), mart_min_attempts=10)
    assert spark.read.parquet(out.table("deliveries")).count() == 1500
    segments = spark.read.parquet(out.table("fadr_by_segment"))
    assert segments.count() == 25
    city = spark.read.parquet(out.table("mart_fadr_by_city_and_address"))
    assert city.columns == [
        "city", "address_type", "total_attempts", "successful_deliveries", "fadr", "failure_rate",
        "avg_order_value",
    ]
    assert spark.read.parquet(out.table("mart_fadr_by_window_and_alerts")).count() > 0
    exported = spark.read.schema(segments.schema).option("header", True).csv(
        out.export("fadr_by_segment")
    )
    assert exported.exceptAll(segments).isEmpty() and exported.count() == 25


def test_a_failed_check_stops_before_the_export(spark, attempts, tmp_path):
    write_deliveries_csv(attempts({"delivery_id": "x"}, {"delivery_id": "x"}), str(tmp_path / "in"))
    with pytest.raises(QualityError, match="unique"):
        run_daily(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert not (tmp_path / "out" / "exports").exists()
    assert DailyOutputs("o").table("t") == "o/tables/t"


def test_broken_values_stay_out_of_the_marts(spark, attempts, tmp_path):
    sound = attempts({"city": "Pune"}, {"city": "Pune"}, {"city": "Pune"}, {"city": "Pune"})
    text = sound.select([F.col(c).cast("string").alias(c) for c in sound.columns])
    broken = text.limit(1).withColumns({"delivery_id": F.lit("bad"), "order_value": F.lit("ten"), "city": F.lit(None).cast("string")})
    write_deliveries_csv(text.unionByName(broken), str(tmp_path / "in"))
    out = run_daily(spark, str(tmp_path / "in"), str(tmp_path / "out"), mart_min_attempts=1)
    rejected = spark.read.parquet(out.table("rejected")).collect()
    assert [(r.delivery_id, r.reason) for r in rejected] == [("bad", "city is missing; order_value does not parse")]
    mart = spark.read.parquet(out.table("mart_fadr_by_city_and_address")).collect()
    assert [(r.city, r.total_attempts) for r in mart] == [("Pune", 4)]
    flagged = text.withColumn("has_delivery_preference", F.lit("7"))
    write_deliveries_csv(flagged, str(tmp_path / "flagged"))
    with pytest.raises(QualityError, match="has_delivery_preference"):
        run_daily(spark, str(tmp_path / "flagged"), str(tmp_path / "out2"))
    assert not (tmp_path / "out2" / "tables" / "fadr_by_segment").exists()


def snapshot(spark, tmp_path):
    out = DailyOutputs.published(spark, str(tmp_path / "out"))
    return out and {
        "attempts": spark.read.parquet(out.table("deliveries")).count(),
        "city": sorted(map(tuple, spark.read.parquet(out.table("mart_fadr_by_city_and_address")).collect())),
        "export": sorted(r.value for r in spark.read.text(out.export("fadr_by_segment")).collect()),
    }


@pytest.mark.parametrize("step", ["mart", "check", "export", "switch"])
def test_a_run_that_stops_leaves_the_former_outputs(spark, landing, attempts, tmp_path, monkeypatch, step):
    from doorstep.plans import daily_job

    assert snapshot(spark, tmp_path) is None
    run_daily(spark, landing, str(tmp_path / "out"), mart_min_attempts=10)
    before = snapshot(spark, tmp_path)
    assert before["attempts"] == 1500 and len(before["export"]) > 25

    def stop(*args, **kwargs):
        raise KeyboardInterrupt(step)

    # Between two marts, at a check of the marts, between two exports, before the switch.
    calls = {"n": 0}
    real_export = daily_job.export_mart

    def second_export(*args):
        calls["n"] += 1
        return real_export(*args) if calls["n"] == 1 else stop()

    patch = {"mart": ("mart_window_alerts", stop), "check": ("mart_checks", stop), "export": ("export_mart", second_export)}
    if step == "switch":
        monkeypatch.setattr(daily_job.publish, "switch", stop)
    else:
        monkeypatch.setattr(daily_job, *patch[step])
    write_deliveries_csv(attempts({"city": "Pune"}, {"city": "Pune"}), str(tmp_path / "next"))
    with pytest.raises(KeyboardInterrupt):
        run_daily(spark, str(tmp_path / "next"), str(tmp_path / "out"), mart_min_attempts=1)
    assert snapshot(spark, tmp_path) == before
    monkeypatch.undo()
    run_daily(spark, str(tmp_path / "next"), str(tmp_path / "out"), mart_min_attempts=1)
    assert snapshot(spark, tmp_path)["attempts"] == 2


def test_pointers(spark, tmp_path):
    from doorstep.sources import publish

    out = str(tmp_path)
    versions = []
    for k in range(4):
        versions.append(publish.new_version(out))
        spark.range(k + 1).write.parquet(versions[-1])
        publish.switch(spark, out, versions[-1])
        assert publish.current(spark, out) == versions[-1]
    assert {p.name for p in (tmp_path / "versions").iterdir()} == {v.rsplit("/", 1)[1] for v in versions[-2:]}
    # Going back to a former version, and a pointer that was not written to the end.
    publish.switch(spark, out, versions[-2])
    (tmp_path / "current-000000000009").write_text("half")
    assert publish.current(spark, out) == versions[-2] and spark.read.parquet(versions[-2]).count() == 3


def test_marts_are_rolled_up_from_one_scan(spark, landing, tmp_path, monkeypatch):
    """After landing and checks the attempts are read once; the marts equal those built from the attempts."""
    from doorstep.operators import marts
    from doorstep.operators.staging import stage_deliveries
    from doorstep.plans import daily_job

    summed, real = [], daily_job.summarise
    monkeypatch.setattr(daily_job, "summarise", lambda df: summed.append(df) or real(df))
    out = run_daily(spark, landing, str(tmp_path / "out"), mart_min_attempts=10)
    assert len(summed) == 1
    staged = stage_deliveries(spark.read.parquet(out.table("deliveries")))
    for name, direct in {
        "fadr_by_segment": marts.fadr_by_segment(staged),
        "mart_fadr_by_city_and_address": marts.mart_city_address(staged),
        "mart_fadr_by_window_and_alerts": marts.mart_window_alerts(staged, min_attempts=10),
    }.items():
        built = spark.read.parquet(out.table(name))
        # Only the mean value is a sum of doubles, in another order.
        rounded = lambda df: df.withColumn("avg_order_value", F.round("avg_order_value", 6)) if "avg_order_value" in df.columns else df
        assert built.dtypes == direct.dtypes, name
        assert sorted(map(repr, rounded(built).collect())) == sorted(map(repr, rounded(direct).collect())), name
        files = {f for f in built.inputFiles()}
        assert files and all("/versions/" in f for f in files)


def test_summaries_of_loads_merge(spark, attempts):
    from doorstep.operators import marts, summary

    loads = [
        attempts({"city": "Pune", "is_successful": 1}, {"city": "Pune", "is_successful": 0}),
        attempts({"city": "Pune", "is_successful": None}, {"city": None, "is_successful": 1}, {"city": "Delhi", "is_successful": None}),
        attempts({"city": "Delhi", "order_value": None}),
    ]
    every = loads[0].unionByName(loads[1]).unionByName(loads[2])
    merged = summary.merge(*[summary.summarise(d) for d in loads])
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(merged) == rows(summary.summarise(every))
    assert rows(summary.fadr_by_segment(merged)) == rows(marts.fadr_by_segment(every))
    assert rows(summary.mart_city_address(merged)) == rows(marts.mart_city_address(every))
    assert rows(summary.mart_window_alerts(merged, min_attempts=0)) == rows(marts.mart_window_alerts(every, min_attempts=0))
    assert summary.fadr_by(merged).first().total_attempts == 6
    assert summary.summarise(every.limit(0)).count() == 0 and summary.mart_city_address(summary.summarise(every.limit(0))).count() == 0
