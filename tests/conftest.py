import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from transit_engine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", shuffle_partitions=4)
    yield session
    session.stop()


def rows(df, *names):
    """The rows as sorted tuples."""
    chosen = df.select(*names) if names else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
