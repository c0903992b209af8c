import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from postscope.session import get_session
    ckpt = tempfile.mkdtemp(prefix="postscope-test-")
    s = get_session("local[4]", app="postscope-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
