import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from payscope.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="payscope-tests", shuffle_partitions=8,
                      driver_memory="6g")
    # tests only: the shared checkpoint folder is unset locally
    checkpoint_dir(s, tempfile.mkdtemp(prefix="payscope-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="payscope-test-out-")
