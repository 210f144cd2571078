import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from doorstep.schema import DELIVERIES, DELIVERY_COLUMNS  # noqa: E402
from doorstep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "doorstep-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


DEFAULTS = {
    "customer_id": "c1",
    "city": "Pune",
    "address_type": "House",
    "delivery_window": "Evening (15-19)",
    "order_value": 750.0,
    "is_successful": 1,
    "failure_reason": None,
    "attempt_number": 1,
    "attempt_date": dt.date(2024, 1, 15),
    "attempt_hour": 15,
    "has_delivery_preference": 0,
    "proximity_alert_sent": 0,
}


@pytest.fixture
def attempts(spark):
    """Build attempt records from partial dicts; anything left out takes a plain default."""

    def build(*rows: dict):
        nullable = type(DELIVERIES)([type(f)(f.name, f.dataType, True) for f in DELIVERIES])
        full = [
            tuple({"delivery_id": f"d{i}", **DEFAULTS, **row}[c] for c in DELIVERY_COLUMNS)
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(full, nullable)

    return build


@pytest.fixture
def rows():
    """Collected rows as plain tuples, in order."""
    return lambda df: [tuple(r) for r in df.collect()]
