import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskpipe.session import get_session
    s = get_session("local[8]", 8, app_name="riskpipe-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskpipe-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from riskpipe.session import local_fs_path, scratch_path
    p = scratch_path(spark, "test")
    os.makedirs(local_fs_path(p), exist_ok=True)
    return local_fs_path(p)
