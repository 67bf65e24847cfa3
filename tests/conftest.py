import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def spark():
    from quillspark.session import checkpoint_dir, get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8, driver_memory="4g")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("qs"))


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="qs-test-", dir="/tmp")
