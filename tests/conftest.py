import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from locusflow.session import local_session

    session = local_session("tests", "8", 4)
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A one-column DataFrame of text lines."""

    def make(*text):
        return spark.createDataFrame([(t,) for t in text], "value string")

    return make
