import os
import sys

import pytest

os.environ.setdefault("RUMBO_ROW_GROUP_BYTES", str(2 * 1024 * 1024))     # few-MB test tables
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rumbo.session import local_session
    s = local_session("*", shuffle_partitions=8, app="rumbo-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
