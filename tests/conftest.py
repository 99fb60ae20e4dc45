from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", sys.path[0])

from quire.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
