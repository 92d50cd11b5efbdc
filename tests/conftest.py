import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from zonecast.config import TEST_CONFIG  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from zonecast.session import build_session

    s = build_session("local[4]", 4, app_name="zonecast-tests")
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder (a cluster names a shared one).
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="zonecast-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def cfg():
    return TEST_CONFIG


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="zonecast-test-")
