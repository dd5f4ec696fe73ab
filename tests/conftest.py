import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session
    s = local_session("4", app="ledgerlake-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerlake-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from ledgerlake.session import fresh_dir
    return fresh_dir(spark, "test")
