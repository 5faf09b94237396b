import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scrubjay.session import get_spark

    wh = tempfile.mkdtemp(prefix="scrubjay-wh-")
    s = get_spark("local[4]", app="scrubjay-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": wh,
                         "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="scrubjay-test-")
