import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lekhani.session import build_session, ship_package  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", cores="4", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)
