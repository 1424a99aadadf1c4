import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from marketspark.session import local_session

    return local_session(8)
