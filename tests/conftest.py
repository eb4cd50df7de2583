from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loanlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            # Driver and tasks share one heap here, and pages of 50 MB do not fit the usual 1 GB four times.
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over rows of (name, type, values...)."""

    def run(schema: str, rows, make):
        df = spark.createDataFrame(rows, schema)
        return [r[0] for r in df.select(make(df)).collect()]

    return run


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
