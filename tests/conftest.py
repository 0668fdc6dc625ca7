import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arraytide import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build("tests", cores=8, shuffle_partitions=4, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
