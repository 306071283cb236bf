import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import registry  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def work(spark, sf_dir):
    """Shared workspace with quick model sizes; its tables are materialised once."""
    return registry.workspace(spark, sf_dir, p=registry.QUICK_PARAMS)
