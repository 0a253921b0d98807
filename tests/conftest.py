import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orderdesk.session import build_session
    import tempfile
    wh = tempfile.mkdtemp(prefix="orderdesk-wh-")
    s = build_session(master="local[4]", shuffle_partitions=4, extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
