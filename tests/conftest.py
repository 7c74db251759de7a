import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from logloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="logloom-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="logloom-test-warehouse-")
    s = get_session("local[*]", shuffle_partitions=4, extra={"spark.checkpoint.dir": ckpt,
                                                            "spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from logloom.session import shared_dir
    return shared_dir(spark, "test")
