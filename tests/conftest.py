import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
