import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from fieldhouse.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "fieldhouse-tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g", spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="fieldhouse-warehouse-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture()
def tight():
    """Limits so small that every skew-safe branch is taken."""
    from fieldhouse.operators.sizing import Limits
    return Limits(group_rows=40, broadcast_rows=5, probe_free_bytes=0, broadcast_free_bytes=0)
