import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def tiny_bounds(monkeypatch):
    """Nothing counts as small, so every operator takes its large-data way."""
    from tabloom.operators import encode, lookup

    monkeypatch.setattr(lookup, "MAX_ROWS", 0)
    monkeypatch.setattr(encode, "MAX_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_KEYS", 3)
