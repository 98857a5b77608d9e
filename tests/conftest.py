import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.local(8)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")
