import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session(master="local[8]", app="tidewater-tests", shuffle_partitions=8)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-test-ckpt-"))
    yield s
