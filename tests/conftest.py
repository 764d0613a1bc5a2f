import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from arrears.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="arrears-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
