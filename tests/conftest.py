from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", extra={
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def one(spark):
    """Evaluate columns over one row of literals: ``one({"a": (1, "int")}, {"x": col})``."""
    def run(row: dict, columns: dict):
        schema = ", ".join(f"`{n}` {kind}" for n, (_, kind) in row.items())
        frame = spark.createDataFrame([tuple(v for v, _ in row.values())], schema)
        return frame.select(*[c.alias(n) for n, c in columns.items()]).first()

    return run
