import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from zonehour.session import build_session

    s = build_session("local[4]", 4, app="zonehour-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
