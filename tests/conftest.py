import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkloom.session import session

    shared = tempfile.mkdtemp(prefix="shared-")
    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=f"{shared}/warehouse", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import compare

    return compare.duck(sf)
