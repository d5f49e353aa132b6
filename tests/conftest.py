import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from wardflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])
    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
