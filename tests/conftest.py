import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from emporia.session import get_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = get_session("local[4]", app="emporia-tests", shuffle_partitions=4,
                    conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
