import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from placeframe.session import build_session

    s = build_session("local[4]", app_name="placeframe-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the shared checkpoint root (never reused)."""
    from placeframe.session import fresh_dir

    return fresh_dir(spark, "test")


@pytest.fixture()
def local_dir():
    """A fresh local folder for hand-written input files."""
    return tempfile.mkdtemp(prefix="placeframe-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
