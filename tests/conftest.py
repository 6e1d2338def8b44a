import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from glossmill.session import local_session, ship

    s = local_session(cpus=8, memory="6g", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    ship(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
