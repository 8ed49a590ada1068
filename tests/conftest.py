import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from keelson.session import local_session
    s = local_session("*", app="keelson-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from keelson.session import scratch_path
    return lambda label="t": scratch_path(spark, label)
