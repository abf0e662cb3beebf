import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyloom.session import build_session

    return build_session("tests", 8)


@pytest.fixture(scope="session")
def con():
    from oracle import connect

    return connect(SMALL)


@pytest.fixture
def hot(spark):
    """Limits so low that every group is hot and nothing is broadcast."""
    from oracle import set_hot

    set_hot(spark)
    yield spark
    set_hot(spark, False)
