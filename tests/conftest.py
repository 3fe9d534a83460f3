import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from metricloom.session import local_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8, **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    """A new folder in the shared place of the session."""
    return work_dir(spark, "test")
