import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="tillroll-wh-")
    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g",
                      extra={"spark.sql.warehouse.dir": wh})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tillroll-test-")
