import sys

import pytest

from places import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[4]", 4, driver_memory="8g")
    yield s
    s.stop()
