import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vesseltrack.session import get_session
    wh = tempfile.mkdtemp(prefix="vt-warehouse-")
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": wh, "spark.default.parallelism": "4"})
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="vt-test-")
