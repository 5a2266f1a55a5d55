from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.lake import Lake  # noqa: E402
from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "strata-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
        "local[4]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:10]}_")


@pytest.fixture
def flights_csv(tmp_path):
    """The three sample rows; the last one is cancelled and has no delays."""
    path = tmp_path / "flights.csv"
    path.write_text(
        "OP_UNIQUE_CARRIER,ORIGIN,DEST,DEP_DELAY_NEW,ARR_DELAY_NEW,CANCELLED,DISTANCE\n"
        "WN,PHX,BWI,82.0,57.0,0.0,1999.0\n"
        "DL,ATL,LIT,9.0,1.0,0.0,453.0\n"
        "AA,ABQ,DFW,,,1.0,569.0\n"
    )
    return str(path)


def plan_of(df) -> str:
    """Executed plan as text, after the run where AQE settled it."""
    return df._jdf.queryExecution().executedPlan().toString()
