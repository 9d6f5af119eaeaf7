import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vitalspark.session import build_session
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from harness import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_oracle():
    from harness import duck
    return duck(SF_ORACLE)
