import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from trafficlens.session import local_session

    s = local_session("*", shuffle_partitions=8, app="trafficlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck001():
    from oracle_check import duck

    return duck(SF001)


@pytest.fixture(scope="session")
def duck01():
    from oracle_check import duck

    return duck(SF01)
