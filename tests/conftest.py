import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidecast.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    session = build_session("tests", master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return os.path.join(TESTDATA, "sf0.001")
