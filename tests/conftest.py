import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from obsflow.session import build_session, ensure_shared_dir, new_work_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    # Uses spark.checkpoint.dir when the environment names one; otherwise
    # creates and registers a temporary folder for the tests.
    ensure_shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    return new_work_path(spark, "test")
