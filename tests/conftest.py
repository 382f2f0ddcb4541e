import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]
DATA = os.environ.get("CORVIDEX_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from corvidex.session import clear, local_session

    s = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield s
    clear(s)
    s.stop()


@pytest.fixture(scope="session")
def base():
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    return DATA
