import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trackstream.session import build_session
    from trackstream.streaming.stateful import ROCKSDB_PROVIDER

    s = build_session("local[4]", app_name="trackstream-tests", shuffle_partitions=4,
                      extra={"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
                             "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ts-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ts-test-")
