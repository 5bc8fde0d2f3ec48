import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cumulo.session import build_session
    scratch = tempfile.mkdtemp(prefix="cumulo-tests-")
    s = build_session("local[4]", app="cumulo-tests", shuffle_partitions=4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cumulo-t-")
