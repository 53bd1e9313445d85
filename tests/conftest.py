import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallyward.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def lines_of(spark):
    """Arrival-numbered ``value`` rows from text lines."""

    def make(lines):
        numbered = list(enumerate(lines, 1))
        return spark.createDataFrame(numbered, "seq bigint, value string")

    return make
