import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from plover.session import build_session
    s = build_session("local[4]", app_name="plover-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="plover-test-")
