import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bizlens.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
