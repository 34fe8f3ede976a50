import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    warehouse = tempfile.mkdtemp(prefix="strata-test-warehouse-")
    s = build_session("local[*]", shuffle_partitions=8, app_name="strata-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", ckpt)
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")
