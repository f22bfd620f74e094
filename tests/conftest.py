import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import checkpoint_dir, local_session
    s = local_session("4", shuffle_partitions=8, app="corpusloom-tests")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="corpusloom-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="corpusloom-test-")
