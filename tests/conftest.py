import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinerank.session import local_session

    s = local_session("*", shuffle_partitions=8, app="cinerank-tests")
    yield s
    s.stop()
