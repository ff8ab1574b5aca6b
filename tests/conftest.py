import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reelhouse.session import get_spark

    warehouse = tmp_path_factory.mktemp("warehouse")
    s = get_spark(
        "tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()
