import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hourmart.session import get_session, shared_dir

    s = get_session("local[4]", app="hourmart-tests", shuffle_partitions=8)
    # the session's shared folder is used when set; tests only fill it in if it is missing
    shared_dir(s, tempfile.mkdtemp(prefix="hourmart-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="hourmart-test-", dir="/tmp")
