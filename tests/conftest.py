import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tillstar.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="tillstar-test-ckpt-")
    s = get_spark(master="local[*]", shuffle_partitions=8,
                  extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tillstar-test-")
