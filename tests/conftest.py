import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import get_session

    ckpt = tempfile.mkdtemp(prefix="tidepool-test-ckpt-")
    s = get_session("local[8]", app_name="tidepool-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt,
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidepool-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tidepool-run-")
