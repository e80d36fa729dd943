import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ohlcflow.session import get_session
    s = get_session("local[4]", 8, app="ohlcflow-tests", extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ohlcflow-test-ckpt-"))
    yield s
    s.stop()


def fixture_path(name):
    return os.path.join(FIXTURES, name)


def have_testdata():
    return os.path.exists(os.path.join(SF_SMALL, "events.parquet"))
