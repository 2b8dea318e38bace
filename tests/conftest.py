import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chainyard.session import build_session
    s = build_session("local[*]", app="chainyard-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh scratch folder under the session's checkpoint location."""
    from chainyard.session import shared_dir
    return shared_dir(spark, "test")


@pytest.fixture()
def localdir():
    return tempfile.mkdtemp(prefix="chainyard-test-")
