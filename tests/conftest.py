import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from palimpsest.session import ensure_checkpoint_dir, get_session
    s = get_session("local[*]", app="palimpsest-tests", shuffle_partitions=8)
    # Tests set their own checkpoint folder only because none is configured.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="palimpsest-test-ckpt-"))
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="palimpsest-test-")


@pytest.fixture(autouse=True, scope="module")
def no_cached_rows_left():
    """What a module's tests cached goes with the module: others count what is kept."""
    from pyspark.sql import SparkSession
    yield
    if s := SparkSession.getActiveSession():
        s.catalog.clearCache()
