import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from freightlake.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app_name="freightlake-tests",
                      extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder (a cluster names it in spark.checkpoint.dir).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="freightlake-test-ckpt-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
