"""One local session for all tests, and a small helper for rows."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from framemill.session import local_session

    session = local_session("tests", cores="8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    """Folder of the smallest test tables."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
