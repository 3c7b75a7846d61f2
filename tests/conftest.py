import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from layerkit.session import build_session
    s = build_session("local[4]", app_name="layerkit-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_area(spark):
    """A fresh folder below the session's checkpoint root."""
    from layerkit.session import scratch_path
    return scratch_path(spark, "test")


@pytest.fixture()
def local_dir():
    """A fresh local folder for hand-written fixture files."""
    return tempfile.mkdtemp(prefix="layerkit-fixture-")
