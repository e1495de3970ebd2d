import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__  # noqa: E402,F401  makes the packages reach the Python workers
from lectern.session import fresh_path, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "8g")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new path under the shared folder; nothing is there yet."""
    return fresh_path(spark, "test")


@pytest.fixture(scope="session")
def small():
    return SMALL
