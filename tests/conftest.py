import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfscope.session import build_session
    s = build_session("local[4]", app="shelfscope-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfscope-test-ckpt-"))
    yield s
    s.stop()
