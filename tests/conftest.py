import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from stratum.session import build_session

    builder_conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()
    s = build_session("local[4]", app_name="stratum-tests", shuffle_partitions=8, conf=builder_conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="stratum-test-", dir=os.environ.get("TMPDIR", "/tmp"))


@pytest.fixture(autouse=True)
def own_caches():
    """Tables that a test caches go with it: later tests count what is persisted."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
