import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellweave.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="cellweave-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def at():
    """The n-th second of a fixed day."""
    start = dt.datetime(2024, 1, 1)
    return lambda n: start + dt.timedelta(seconds=n)
