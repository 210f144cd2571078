import json
from pathlib import Path

import pytest

from doorstep.__main__ import main
from doorstep.operators.quality import QualityError
from doorstep.plans.daily_job import DailyOutputs
from doorstep.plans.reports import REPORTS, run_reports
from doorstep.sources.files import write_deliveries_csv
from doorstep.sources.star import deliveries


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing") / "csv")
    write_deliveries_csv(deliveries(spark, sf_dir), folder)
    return folder


def test_reports_job(spark, sf_dir, tmp_path):
    assert run_reports(spark, deliveries(spark, sf_dir), str(tmp_path)) == 1500
    written = {p.name for p in (tmp_path / "reports").iterdir()}
    assert written == set(REPORTS)
    featured = spark.read.parquet(str(tmp_path / "featured"))
    assert {"order_value_bucket", "is_high_risk", "city"} <= set(featured.columns)
    windows = spark.read.option("header", True).csv(str(tmp_path / "reports" / "fadr_by_window"))
    assert windows.count() == 4


@pytest.mark.parametrize("window", ["Midnight (0-2)", None])
def test_reports_stop_at_an_unknown_window(spark, attempts, tmp_path, window):
    with pytest.raises(QualityError, match="delivery_window"):
        run_reports(spark, attempts({}, {"delivery_window": window}), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_command_line_reports(spark, landing, tmp_path, capsys):
    main(["report", "fadr_by_window", landing])
    assert "Morning (9-12)" in capsys.readouterr().out
    main(["daily", landing, str(tmp_path / "daily")])
    published = DailyOutputs.published(spark, str(tmp_path / "daily"))
    assert Path(published.export("fadr_by_segment")).exists()
    with pytest.raises(SystemExit):
        main(["report", "unknown", landing])


def test_command_line_consumes_events(spark, tmp_path, capsys):
    event = {"delivery_id": "d1", "city": "Pune", "status": "DELIVERED", "timestamp": "2024-01-15T10:00:00"}
    (tmp_path / "log").mkdir()
    lines = [json.dumps(event), json.dumps({**event, "status": "FAILED"}), "not json"]
    (tmp_path / "log" / "a.txt").write_text("\n".join(lines) + "\n")
    main([
        "consume", str(tmp_path / "out"), "--format", "text", "--option", f"path={tmp_path}/log",
        "--available-now",
    ])
    out = capsys.readouterr().out
    assert "50.0" in out and "'batch': 0" in out
    assert spark.read.parquet(str(tmp_path / "out" / "events")).count() == 2
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out" / "malformed")).collect()] == ["not json"]
