import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from peerscope.session import get_session

    ckpt = tempfile.mkdtemp(prefix="peerscope-test-ckpt-")
    s = get_session(master="local[4]", app_name="peerscope-tests", shuffle_partitions=4,
                    extra_conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="peerscope-test-")
